"""Plans: layer loads (Bronze, Silver, Gold), call tree and the table catalog."""
