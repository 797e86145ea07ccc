"""Column expressions. Everything here runs in the JVM."""
