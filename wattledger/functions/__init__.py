"""Column helpers: each takes and returns Spark columns, nothing runs in Python."""
