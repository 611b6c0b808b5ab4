"""Column expressions: text cleaning, event parsing, classification, hashing."""
