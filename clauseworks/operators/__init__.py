"""Operators of the core: each is a DataFrame -> DataFrame function."""
