"""Operators for large text corpora (documents, pages, labels).

Ten operators, each a module with a general interface and real outputs; the
registered queries (``queries.py``) derive the digest columns from them.
Nothing else in the library imports this package.
"""
