"""Operators for preparing training text; see the README for the list."""
