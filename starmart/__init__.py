"""Review analytics on Spark: star schemas and dashboard queries as DataFrame plans."""
