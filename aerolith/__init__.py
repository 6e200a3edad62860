"""Spark-native analytics for hourly environmental series."""
