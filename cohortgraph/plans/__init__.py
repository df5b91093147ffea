"""Analytics questions expressed over the operators' tables."""
