"""Column expressions and column-list steps."""
