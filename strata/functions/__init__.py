"""Column -> Column expressions. All stay on the JVM side, none ever raises on bad text."""
