"""Column expressions shared by the layers; every one is a built-in Spark expression."""
