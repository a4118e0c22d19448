"""Operators of a training-data pipeline: packing, filtering, deduplication, extraction, archives.

Nothing else in the library imports this subpackage.
"""
