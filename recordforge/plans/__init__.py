"""recordforge.plans."""
