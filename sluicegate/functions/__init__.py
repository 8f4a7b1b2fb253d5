"""Column expressions: byte decoding, type names and casts, generation names."""
