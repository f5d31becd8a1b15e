"""Ordermart: order lakehouse and card-fraud operators on Spark DataFrames,
Spark SQL and Structured Streaming."""

__version__ = "0.1.0"
