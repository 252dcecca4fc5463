"""Metered consumption and billing analytics as plain Spark DataFrame plans."""
