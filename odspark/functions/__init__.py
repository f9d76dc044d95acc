"""Column builders (JVM-side expressions only, no Python UDFs)."""
