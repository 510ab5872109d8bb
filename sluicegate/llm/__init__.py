"""Operators for preparing training text.

Each module holds one operator with a general interface.  ``queries.py`` applies them to
the test tables.  Nothing outside this package imports it.
"""
