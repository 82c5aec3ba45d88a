"""Column -> Column functions: text cleaning, value parsing, URLs."""
