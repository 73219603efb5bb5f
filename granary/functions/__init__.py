"""Column expressions: labels, paths, hashes, numbers in text and boxes."""
