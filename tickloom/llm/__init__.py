"""Operators for preparing training data. Nothing else in the library depends on this package."""
