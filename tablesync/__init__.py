"""tablesync: keep tables in sync from change events, and flatten nested documents, on Spark."""

__version__ = "0.1.0"
