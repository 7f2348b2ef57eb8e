"""Spark-native analytics for tabular binary-risk data."""
