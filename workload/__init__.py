"""The registered queries: inputs derived from the given tables, calls, and their SQL."""
