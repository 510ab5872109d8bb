"""Registered queries over the test tables, their inputs and their SQL equivalents."""
