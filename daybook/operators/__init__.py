"""Frame-to-frame operators and partition upkeep."""
