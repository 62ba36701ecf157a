"""Operators on events and change rows, as DataFrame to DataFrame."""
