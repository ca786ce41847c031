"""Column expressions: every function takes and returns columns and stays inside the JVM."""
