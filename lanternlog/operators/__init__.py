"""Operators over normalized log tables."""
