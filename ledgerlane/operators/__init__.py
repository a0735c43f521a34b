"""Reusable DataFrame operators: joins, latest rows, pivots, checks, keyed updates, net changes."""
