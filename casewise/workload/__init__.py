"""Queries over the given test tables, each with its SQL counterpart."""
