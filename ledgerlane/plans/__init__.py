"""Whole reports: portfolio, alerts, trips, run log, and the daily chain."""
