"""Price-panel analytics as Spark DataFrame jobs."""
