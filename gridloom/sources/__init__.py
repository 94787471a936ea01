"""Scans: binary tiles, inventories, listings, remote objects."""
