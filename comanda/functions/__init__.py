"""Column expressions and ordered aggregates shared by the operators."""
