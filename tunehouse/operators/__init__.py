"""Reusable relational operators on DataFrames."""
