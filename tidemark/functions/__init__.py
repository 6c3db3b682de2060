"""Column functions: parsing, numbers, keys and labels."""
