"""Reusable DataFrame operators: windows, lookups, criteria, quality, hierarchy, baskets."""
