"""Spark-native analytics for labelled numeric event tables."""

__version__ = "0.1.0"
