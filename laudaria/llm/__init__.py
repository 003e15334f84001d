"""Operators for building training data out of free text. Nothing else in the library imports this package."""
