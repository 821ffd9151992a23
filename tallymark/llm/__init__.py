"""Operators for preparing training text, their queries and the SQL twins of those."""
