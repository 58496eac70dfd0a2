"""Models, checks, reports and the ingest and build jobs."""
