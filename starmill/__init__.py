"""Wide sales records to a star schema and sales marts, as Spark jobs."""
