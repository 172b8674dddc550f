"""Relational operators, each a function DataFrame -> DataFrame."""
