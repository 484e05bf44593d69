"""Column expressions. All of them stay in the JVM."""
