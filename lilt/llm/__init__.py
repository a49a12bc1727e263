"""Training-data operators: deduplication, mixing, tokenising, search and media columns.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""
