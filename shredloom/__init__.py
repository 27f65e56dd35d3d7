"""XML filings to relational tables on Spark: shred once, extract many."""

__version__ = "0.1.0"
