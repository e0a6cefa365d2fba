"""Operators of a training-data pipeline over the tables documents, embeddings,
pages, benchmark and labels, and the queries that apply them (``queries.py``).

Nothing else in the library imports this subpackage.
"""
