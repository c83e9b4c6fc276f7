"""Column expressions; all stay inside Spark's own expression engine."""
