"""Spark-native environmental time-series engine."""
