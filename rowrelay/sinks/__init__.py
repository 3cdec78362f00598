"""Where delivered records go."""
