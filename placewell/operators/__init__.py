"""Relational building blocks that take DataFrames and column names."""
