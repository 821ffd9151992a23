"""Ledger reconciliation on Spark: conform, align, compare, keep versioned history."""
