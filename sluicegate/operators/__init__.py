"""DataFrame-to-DataFrame steps of the ingest path."""
