"""Operators of a large-scale training-data pipeline (documents in, documents or per-document facts out).

Each module holds one operator; ``queries.py`` registers them. Nothing else in the package imports from here.
"""
