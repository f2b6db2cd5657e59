"""Column-level building blocks; all of them stay on the JVM side."""
