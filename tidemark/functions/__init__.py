"""Column expressions, exact order statistics and tail probabilities."""
