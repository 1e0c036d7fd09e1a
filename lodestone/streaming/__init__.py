"""Change logs as streams."""
