"""Queries over the shared test tables, each with the SQL that must agree."""
