"""Operators of a training-data pipeline: deduplication, mixing, search, sharding, filtering, packing, extraction.

Nothing else in the library imports this subpackage.
"""
