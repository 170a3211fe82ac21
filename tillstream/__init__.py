"""Sales ranking on Spark: lenient ingestion, hourly top-N, serving reads."""
