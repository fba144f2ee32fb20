"""Continuous forms of the batch transforms."""
