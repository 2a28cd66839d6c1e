"""Whole jobs and SQL entry points."""
