"""Spark-native curation analytics for large media and text collections."""
