"""Contact, registry and procurement analytics as Spark DataFrame jobs."""
