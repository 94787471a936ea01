"""Column expressions: lattice arithmetic, unit encoding, projection, metadata."""
