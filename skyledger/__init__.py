"""Spark-native analytics over wide tables of environmental sensor readings."""

__version__ = "0.1.0"
