"""Operators that prepare text, pages and vectors for language-model training."""
