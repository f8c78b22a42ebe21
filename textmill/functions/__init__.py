"""Column functions: text in, text or measures out."""
