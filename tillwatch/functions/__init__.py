"""Column builders: each takes columns and returns a column, all JVM-side."""
