"""Readers of tables and documents."""
