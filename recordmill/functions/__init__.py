"""Column builders and small aggregates shared by the operators."""
