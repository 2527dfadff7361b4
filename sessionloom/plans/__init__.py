"""Registered queries: an operator applied to the given tables, with its SQL check."""
