"""Writers: CSV files and full-refresh tables."""
