"""Daily rate and price history kept as typed, deduplicated fact tables on Spark."""

__version__ = "0.1.0"
