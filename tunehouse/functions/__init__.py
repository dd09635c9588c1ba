"""Scalar expressions. All are native Column expressions, no Python UDF."""
