"""Spark-native analytics for daily mobility time series."""
