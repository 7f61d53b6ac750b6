"""Column functions: pure expressions over one row."""
