"""Operators of the materials-property engine."""
