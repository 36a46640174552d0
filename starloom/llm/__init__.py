"""Operators of a training-data pipeline over the document, page and conversation tables.

Nothing else in the library imports this subpackage.
"""
