"""Daily price x macro feature pipeline written as Spark DataFrame jobs."""
