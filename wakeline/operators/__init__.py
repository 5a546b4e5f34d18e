"""Relational operators: DataFrames in, DataFrame out, lazy throughout."""
