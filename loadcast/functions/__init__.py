"""Column expressions and the holiday dimension."""
