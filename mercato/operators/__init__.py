"""Operators. Each takes and returns DataFrames."""
