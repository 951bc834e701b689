"""Column functions: text, times, names and titles."""
