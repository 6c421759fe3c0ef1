"""Registered queries, their SQL counterparts and the comparison of both."""
