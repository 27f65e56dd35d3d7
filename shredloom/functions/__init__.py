"""Column expressions: paths, identifiers, version lists."""
