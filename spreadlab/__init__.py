"""Spark-native analytics for fixed-income market data."""

__version__ = "0.1.0"
