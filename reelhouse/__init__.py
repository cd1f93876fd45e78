"""Film-catalogue analytics on Spark: typed ingest, star schema, checks and reports."""
