"""Compositions of operators over the mapped tables."""
