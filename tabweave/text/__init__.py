"""Document text: markup, outlines, pages, numbering, formats and templates."""
