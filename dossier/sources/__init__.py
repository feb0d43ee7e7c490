"""Source scan, type detection and adapters."""
