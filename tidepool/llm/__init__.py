"""Operators of a training-data pipeline over the tables of documents, pages and embeddings.

One module per operator with its own general interface; ``queries`` registers each over its whole
table. Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
