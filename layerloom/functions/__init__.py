"""Column expressions and skew helpers shared by the operators."""
