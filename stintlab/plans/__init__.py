"""Whole conversions and reports."""
