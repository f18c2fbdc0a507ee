"""Column expressions: measured numbers, rounding, text, dates and hashes."""
