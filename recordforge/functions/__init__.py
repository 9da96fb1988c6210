"""recordforge.functions."""
