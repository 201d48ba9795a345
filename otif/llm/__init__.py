"""Operators for preparing training text, on the shared document tables.

Nothing else in the library imports this package; it can be deleted whole.
"""
