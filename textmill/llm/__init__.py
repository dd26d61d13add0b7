"""Operators of a large training-data pipeline, one module each.

Nothing else in the library imports this package; it may import the library's general helpers.
"""
