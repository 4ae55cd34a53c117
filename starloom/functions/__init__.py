"""Column -> Column building blocks; all stay inside the JVM."""
