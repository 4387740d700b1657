"""Warehouse plans: calendar, dimensions, facts, loads, marts, measures, reports, checks."""
