"""Column expressions: fixed patterns, cell predicates, names, sizes and row keys."""
