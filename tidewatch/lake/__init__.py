"""Commits over plain tables, for sessions without a lake table format."""
