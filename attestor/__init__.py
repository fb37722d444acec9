"""Spark-native extraction, verification and evaluation of document collections."""

__version__ = "0.1.0"
