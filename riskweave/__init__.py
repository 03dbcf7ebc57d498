"""Model-risk analytics expressed as Spark DataFrame jobs."""
