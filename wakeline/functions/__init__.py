"""Column functions: Columns in, Column out, no Python on the row path."""
