"""recordforge.streaming."""
