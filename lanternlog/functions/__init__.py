"""Column functions: time, redaction, field names."""
