"""Column functions: text rewriting, JSON fields, tags."""
