"""Operators for large text corpora.

Nothing else in the library imports this subpackage; it may be removed as a
whole.  ``queries`` registers one query per operator, ``sql`` holds the SQL of
those that SQL can express.
"""
