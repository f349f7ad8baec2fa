"""The query catalogue: operators applied to the given tables, with their SQL checks."""
