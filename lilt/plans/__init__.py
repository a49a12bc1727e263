"""Whole jobs: labelling and text enrichment."""
