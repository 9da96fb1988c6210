"""recordforge.operators."""
