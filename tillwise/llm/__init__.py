"""Operators for training-data preparation (text corpora at cluster scale).

Nothing else in the library imports this package.  ``queries.py`` holds the
registered queries; every other module is one operator with its own interface.
"""
