"""Readers of log sources."""
