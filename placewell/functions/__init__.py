"""Column builders: null-aware ordering, scalar expressions, keyword classes."""
