"""Captures that follow a log as it grows."""
