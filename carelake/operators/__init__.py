"""Reusable relational operators: DataFrame -> DataFrame."""
