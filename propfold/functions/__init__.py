"""Column expressions: names and values."""
