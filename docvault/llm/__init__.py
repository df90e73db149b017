"""Operators of a training-data pipeline over tables of documents, pages, conversations and vectors.

Nothing else in the library imports this subpackage.  Each ``<operator>.py`` holds one operator with a general
interface; ``queries.py`` registers one query per operator over the whole generated tables.
"""
