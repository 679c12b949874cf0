"""Readers and writers for event data."""
