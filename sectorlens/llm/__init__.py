"""Operators that prepare training data: thirteen operators, their queries and SQL."""
