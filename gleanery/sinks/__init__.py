"""Published tables and their upkeep."""
