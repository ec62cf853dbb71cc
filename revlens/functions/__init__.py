"""Column-expression helpers (all JVM built-ins)."""
