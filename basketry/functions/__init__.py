"""Column expressions and helpers the operators share."""
