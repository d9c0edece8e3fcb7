"""Column -> Column functions; all stay in JVM expressions."""
