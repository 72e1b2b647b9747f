"""Operators for large-scale training-data preparation, each usable on any DataFrame with
``doc_id`` and ``text`` columns, and the queries that apply them to the documents table."""
