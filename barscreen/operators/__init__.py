"""barscreen.operators."""
