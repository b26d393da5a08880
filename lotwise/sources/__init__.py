"""lotwise.sources."""
