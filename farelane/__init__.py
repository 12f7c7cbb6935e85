"""Farelane: period reports, mart publishing and table migration for toll-revenue
star schemas, written as lazy PySpark DataFrame jobs."""
