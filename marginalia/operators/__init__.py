"""Operators: every function takes and returns DataFrames (or a fitted Spark ML model)."""
