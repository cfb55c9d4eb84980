"""Spark-native operators for index, price and cost series."""
