"""Registered queries on the sample tables and their SQL twins."""
