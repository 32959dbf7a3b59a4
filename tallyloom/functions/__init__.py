"""Column expressions: Column in, Column out, all evaluated inside the JVM."""
