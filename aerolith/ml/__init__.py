"""Clustering and forecasting with Spark ML."""
