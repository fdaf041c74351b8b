"""Where posts come from and where results go."""
