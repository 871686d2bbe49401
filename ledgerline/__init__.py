"""Analytics over event and dimension tables, written as Spark jobs."""
