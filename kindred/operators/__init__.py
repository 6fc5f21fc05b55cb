"""Collaborative-filtering operators: DataFrames in, DataFrame out, nothing collected."""
