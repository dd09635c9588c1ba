"""Independent SQL for every named query."""
