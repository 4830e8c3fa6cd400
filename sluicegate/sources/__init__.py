"""Reading delimited files: scans, per-file heads, dialect detection, file inventory."""
