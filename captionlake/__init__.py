"""Spark-native transcript and subtitle analytics."""
