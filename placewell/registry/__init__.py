"""Queries over the given tables, and the SQL they must agree with."""
