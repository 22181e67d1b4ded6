"""Plans that combine many tags."""
