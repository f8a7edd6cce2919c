"""Operators on record frames."""
