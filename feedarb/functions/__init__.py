"""Column expressions: keys, placement, headers, identities and times."""
