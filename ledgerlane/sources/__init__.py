"""Reading and writing files: delimited text, raw lines, JSON arrays, listings, appends, exports."""
