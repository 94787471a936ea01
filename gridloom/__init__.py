"""Spark-native analytics over sparse gridded data."""
