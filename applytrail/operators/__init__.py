"""Operators: DataFrames in, DataFrames out, nothing executed eagerly."""
