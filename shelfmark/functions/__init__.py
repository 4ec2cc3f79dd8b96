"""Column functions: text, numbers, and the one HTML helper that runs in Python."""
