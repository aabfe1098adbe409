"""Operators for large training corpora: counting, deduplication, filtering, mixing and packing of text.

Nothing outside this subpackage imports it. ``queries`` holds the registered queries.
"""
