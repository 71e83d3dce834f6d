"""Column functions: row-to-document encoding, keys, JSON text, deep merge."""
