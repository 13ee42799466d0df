"""Relational operators over tables."""
