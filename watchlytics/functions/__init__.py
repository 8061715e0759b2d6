"""Column expressions and join patterns shared by the operators."""
