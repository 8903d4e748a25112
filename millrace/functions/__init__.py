"""Column expressions: masking, governance, variant access, dates, keys and ordering."""
