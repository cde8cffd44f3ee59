"""Column functions: parsing, bands, decisions, rounding, redaction, ordering."""
