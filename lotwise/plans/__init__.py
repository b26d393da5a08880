"""lotwise.plans."""
