"""Column expressions and small report helpers."""
