"""Queries over the test tables, each with the SQL that says the same."""
