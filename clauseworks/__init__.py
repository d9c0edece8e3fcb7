"""Clauseworks: regulatory-text analytics as PySpark DataFrame transformations."""
