"""Column expressions: status rules, casts, text and rounding."""
