"""Reusable DataFrame operators: lookups, latest-per-key, numbering, load and run log."""
