"""Spark-native sequence-feature analytics."""
