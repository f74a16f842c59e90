"""Column functions: text, numbers and dates. All of them are built-in Spark expressions."""
