"""Table contracts, files and the mapping of other tables onto the contracts."""
