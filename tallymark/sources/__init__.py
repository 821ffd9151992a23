"""Readers and schemas of the landed extracts."""
