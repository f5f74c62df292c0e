"""Column helpers. Each returns a built-in Spark expression, so plans stay in the JVM."""
