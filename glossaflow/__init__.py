"""glossaflow: corpus translation as Spark DataFrame jobs."""
