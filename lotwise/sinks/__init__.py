"""lotwise.sinks."""
