"""Query specifications and their compilation to DataFrame plans."""
