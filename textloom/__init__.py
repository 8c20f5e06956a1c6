"""Text analytics and document classification as Spark DataFrame jobs."""
