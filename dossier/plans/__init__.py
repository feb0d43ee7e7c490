"""Output configuration, its compiler and the end-to-end plan."""
