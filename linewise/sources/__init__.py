"""Where lines come from and where they go."""
