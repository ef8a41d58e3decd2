"""File streams that keep tables up to date."""
