"""Data quality, metadata and entity detection on Spark DataFrames."""

__version__ = "0.1.0"
