"""Operators for building training text: scans, counts, filters, deduplication, formatting.

Nothing else in the library imports this package.
"""
