"""Operators for preparing language-model training data, one module each.

Nothing else in the library imports this package.  ``queries.py`` holds the
registered queries and their SQL.
"""
