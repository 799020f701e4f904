"""Operators over the tables."""
