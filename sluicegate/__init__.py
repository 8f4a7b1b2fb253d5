"""Typed record ingest on Spark: binary record frames in, one typed table per registered schema out."""
