"""Retail panel analytics written as Spark DataFrame transformations."""
