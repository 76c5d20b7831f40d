"""Column functions: keys and JSON."""
