"""Relational operators over tiles, pixels, levels and ledgers."""
