"""Column expressions: cleaning, JSON arrays, rates."""
