"""Registered queries over the test tables, with SQL equivalents."""
