"""Commerce order analytics as Spark DataFrame jobs."""
