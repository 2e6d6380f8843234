"""Column expressions: Column in, Column out, all built-in JVM functions."""
