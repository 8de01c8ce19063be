"""Review analytics on Spark: ingest, cleaning, load and KPI queries."""
