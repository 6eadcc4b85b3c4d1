"""Column expressions and plan-time helpers."""
