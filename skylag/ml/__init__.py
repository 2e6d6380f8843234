"""Spark ML regression on the feature table."""
