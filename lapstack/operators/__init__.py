"""Column-parameterised ``DataFrame -> DataFrame`` building blocks."""
