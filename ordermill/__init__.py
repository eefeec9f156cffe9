"""Order-document analytics as Spark DataFrame jobs."""
