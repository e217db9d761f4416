"""Relational and text operators."""
