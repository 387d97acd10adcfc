"""Column expressions: every function maps Columns to Columns, with no Python per row."""
