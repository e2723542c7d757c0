"""Queries over the given test tables, each next to the SQL that must agree with it."""
