"""Incremental labelling."""
