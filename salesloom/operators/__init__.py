"""Reusable DataFrame operators that hold up when one key is very frequent."""
