"""Operators over page, entry, item, queue and registry tables."""
