"""Column -> Column builders (native Spark expressions, no Python UDFs)."""
