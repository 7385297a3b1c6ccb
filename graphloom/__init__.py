"""Spark-native analytics over typed knowledge graphs and ordered text."""
