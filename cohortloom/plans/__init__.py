"""Plans and where they come from."""
