"""Transaction-risk analytics as Spark DataFrame jobs."""
