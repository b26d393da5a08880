"""lotwise.operators."""
