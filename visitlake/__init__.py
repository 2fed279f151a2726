"""Service-visit analytics over a star schema, written as plain Spark DataFrame jobs."""
