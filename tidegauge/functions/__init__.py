"""Column expressions (all JVM-side) and plan-time naming helpers."""
