"""Keyed time-series features, monitoring and model governance on PySpark."""
