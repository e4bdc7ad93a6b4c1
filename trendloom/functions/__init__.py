"""Column functions: all built from Spark expressions, no Python UDF."""
