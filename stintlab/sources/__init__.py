"""Readers for raw documents and flat tables, and the cleaners for the latter."""
