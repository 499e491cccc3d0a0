"""Scene-index analytics on Spark: ingest, deduplicate, aggregate, search and audit catalogues of keyed, timed records."""
