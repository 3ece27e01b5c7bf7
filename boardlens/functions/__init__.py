"""Column expressions: geometry, label tokens, rounding, metrics."""
