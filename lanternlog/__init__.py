"""Batch jobs over structured application logs, as plain DataFrame operations."""
