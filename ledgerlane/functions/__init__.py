"""Column functions: numbers, time, text, JSON paths and masks."""
