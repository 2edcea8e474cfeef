"""A Spark library for typed page extraction, catalog ledgers and quality checks."""
