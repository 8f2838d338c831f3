"""Column expressions: IEEE-754 bits, canonical key bytes, buckets, Z-order values."""
