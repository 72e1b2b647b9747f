"""Keyed DataFrame operators."""
