"""Operators for preparing large text corpora (deduplication, filtering, scoring, mixing).

Nothing else in the library imports this subpackage.
"""
