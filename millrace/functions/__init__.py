"""Column functions: every one returns a Column built from native Spark expressions."""
