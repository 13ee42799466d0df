"""Ordered edit scripts for workbooks and documents."""
