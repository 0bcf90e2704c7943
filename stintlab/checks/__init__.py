"""Queries over the given star-schema tables, and SQL that gives the same answers."""
