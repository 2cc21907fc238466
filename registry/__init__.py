"""Queries over the driver's test tables, each with its SQL counterpart."""
