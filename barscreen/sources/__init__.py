"""barscreen.sources."""
