"""Operators for large training-data tables (documents, pages, benchmark).

Each module holds one operator with its own general interface; ``queries.py``
applies them to the test tables. Nothing else in the library imports this
subpackage.
"""
