"""feedloom: Spark jobs for scholarly-feed ingestion, reporting and backfill."""
