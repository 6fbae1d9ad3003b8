"""Operators for large text corpora: filtering, deduplication, tokens, packing, archives, shards.

Nothing else in the library imports this package.
"""
