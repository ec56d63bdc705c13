"""Spark-native analytics over gridded elevation data."""
