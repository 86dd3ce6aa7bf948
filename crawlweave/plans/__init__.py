"""Whole jobs and the named queries."""
