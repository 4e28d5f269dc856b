"""Streaming of the materials-property engine."""
