"""Warehouse builds and named analyses."""
