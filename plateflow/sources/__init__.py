"""Where marketplace tables come from and where results go."""
