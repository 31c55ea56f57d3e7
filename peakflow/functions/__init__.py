"""Column expressions, join helpers and grouped statistics."""
