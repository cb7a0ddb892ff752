"""Operators of a training-data pipeline over a table of documents.

Nothing outside this subpackage imports it. ``registry`` lists its queries.
"""
