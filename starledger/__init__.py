"""Product-rating analytics written as Spark DataFrame jobs."""
