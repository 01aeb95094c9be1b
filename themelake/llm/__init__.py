"""Operators for training-data pipelines: filters, deduplication, tokens, fixity.

Nothing else in the library imports this package.
"""
