"""Reading raw files and writing published tables."""
