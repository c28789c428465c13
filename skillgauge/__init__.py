"""Evaluate time-series predictions at scale with PySpark DataFrames."""
