"""DataFrame operators of the pipeline (header check, cleanse, lookups, ...)."""
