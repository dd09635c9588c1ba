"""Music-store warehouse and analytics as plain Spark DataFrame jobs."""
