"""Column-level helpers: parsing, text, nested data and JSON."""
