"""Writing and maintaining tables."""
