"""Counts kept up to date as changes arrive."""
