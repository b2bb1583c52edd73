"""Registered queries: operators bound to the given tables, with their SQL counterparts."""
