"""barscreen.functions."""
