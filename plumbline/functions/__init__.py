"""Column-level building blocks: rule conditions, encoding, scores."""
