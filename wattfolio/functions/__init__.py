"""Column expressions: dates, numbers and texts."""
