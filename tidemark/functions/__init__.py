"""Column expressions: JSON coercion, times, topics."""
