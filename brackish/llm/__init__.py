"""Operators for building training corpora: filtering, deduplication, extraction, scoring and packing.

Nothing outside this folder imports it.
"""
