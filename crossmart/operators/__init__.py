"""Reusable DataFrame operators: key assignment, first/latest rows, lookups, as-of, SCD2."""
