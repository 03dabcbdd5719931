"""Spark-native engine for building, evolving, de-duplicating, scoring and assembling question datasets."""
