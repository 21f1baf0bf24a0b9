"""Data-engineering operators expressed with the Spark DataFrame, SQL and Structured Streaming APIs."""

__version__ = "0.1.0"
