"""Clickstream growth analytics as Spark DataFrame transformations."""
