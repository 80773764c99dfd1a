"""The registered queries and their SQL counterparts on the given tables."""
