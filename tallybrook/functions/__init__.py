"""Column functions: text, amounts and times of statements."""
