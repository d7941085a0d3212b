"""barscreen.plans."""
