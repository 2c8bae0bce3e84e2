"""The jobs, made of operators."""
