"""Spark-native analytics for per-atom prediction tables."""

__version__ = "0.1.0"
