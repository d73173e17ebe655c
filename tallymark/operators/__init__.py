"""Relational operators: each takes and returns DataFrames, and decides nothing silently."""
