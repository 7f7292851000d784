"""Column functions (text and vector expressions)."""
