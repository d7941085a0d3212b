"""barscreen.streaming."""
