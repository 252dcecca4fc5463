"""Histories, features, rosters and extracts as complete plans."""
