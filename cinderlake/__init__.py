"""Wildfire-occurrence analytics as Spark DataFrame transformations."""
