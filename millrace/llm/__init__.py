"""Operators on training texts; nothing outside this package imports it."""
