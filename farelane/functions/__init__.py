"""Column-level building blocks: calendar, text and fixed labels."""
