"""Ad-event layers on Spark: source, snapshot, staging, ingestion, analytical."""
