"""Total scalar functions over columns."""
