"""Column builders and their pure-Python model."""
