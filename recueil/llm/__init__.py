"""Operators for preparing training data: counts, filters, de-duplication, mixing.

Nothing else in the library imports this subpackage.
"""
