"""Column functions: names, numbers, pages, distances."""
