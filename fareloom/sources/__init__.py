"""Reading, staging and writing tables."""
