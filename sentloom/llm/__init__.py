"""Operators for building training corpora: cleaning, near copies, leaks, mixing, shards.

Nothing else in the package imports this one.
"""
