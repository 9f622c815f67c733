"""Document-corpus ingest and byte-trigram search as Spark DataFrame jobs."""
