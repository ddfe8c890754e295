"""Column expressions: keyed hashes, count-based rates, bands and test tails."""
