"""Operators for preparing text corpora: filtering, searching, mixing, encoding.

Nothing outside this package imports it.
"""
