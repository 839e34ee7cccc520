"""Operators of a training-data pipeline over documents, embeddings and texts.

Each module holds one operator with its own general interface; ``queries`` registers
the thin ``opN_*`` queries on the supplied tables. Nothing else in the library imports
this subpackage.
"""
