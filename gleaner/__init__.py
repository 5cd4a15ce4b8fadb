"""Spark-native analytics over large collections of semi-structured documents."""
