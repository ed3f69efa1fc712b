"""Operators that need joins, grouping, windows or MLlib."""
