"""Data-quality reports and the run log."""
