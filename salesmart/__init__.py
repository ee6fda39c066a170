"""Spark-native bronze / silver / gold operators for sales data."""
