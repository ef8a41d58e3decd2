"""Operators for preparing text corpora at scale: near and exact duplicates,
classifiers, extraction, token counts and files, decontamination, vector search.

Nothing outside this package imports it.
"""
