"""The registered queries and their SQL counterparts for checking."""
