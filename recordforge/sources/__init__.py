"""recordforge.sources."""
