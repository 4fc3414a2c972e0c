"""Star-schema analytics as plain Spark DataFrame jobs."""
