"""boxtrail: box traceability and payload ingest as Spark DataFrame jobs."""
