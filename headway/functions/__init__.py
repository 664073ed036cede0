"""Column expressions: each takes and returns Columns, so Catalyst sees all of it."""
