"""Operators for preparing training text: deduplication, scores, sharding, mixing and encoding.

Nothing else in the library imports this subpackage.
"""
