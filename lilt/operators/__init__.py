"""Relational and frame-sequence operators."""
