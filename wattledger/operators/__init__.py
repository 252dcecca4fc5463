"""DataFrame operators. Column names, thresholds and "today" are arguments."""
