"""Retail sales analytics as Spark DataFrame transformations."""
