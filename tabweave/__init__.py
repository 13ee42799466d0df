"""Spark-first engine for declarative queries over spreadsheet-like tables and documents."""
