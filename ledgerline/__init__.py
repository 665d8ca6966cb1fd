"""ledgerline: a configuration-driven Bronze / Silver / Gold pipeline on Spark."""

__version__ = "0.1.0"
