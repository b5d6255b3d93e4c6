"""Column functions: all built-in Spark expressions, no Python UDFs."""
