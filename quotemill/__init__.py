"""quotemill: market and reference data jobs for Spark tables and streams."""

__version__ = "0.1.0"
