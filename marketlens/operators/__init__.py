"""Reusable relational operators (all DataFrame -> DataFrame)."""
