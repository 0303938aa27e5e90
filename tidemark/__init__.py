"""Spark-native collection, training and scoring of short text posts."""

__version__ = "0.1.0"
