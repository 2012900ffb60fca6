"""Library-circulation analytics as Spark DataFrame jobs."""
