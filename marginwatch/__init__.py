"""Retail event analytics as plain Spark DataFrame operators."""
