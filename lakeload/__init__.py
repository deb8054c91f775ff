"""Lake ingestion, history, export and retention as Spark DataFrame operators and jobs."""
