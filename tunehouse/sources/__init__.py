"""Readers: text files, tables and exchange-rate responses."""
