"""wirestar: network traffic records to a star schema, as Spark jobs."""
