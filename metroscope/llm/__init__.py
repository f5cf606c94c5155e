"""Operators on text corpora: scoring, mixing, filtering, deduplication, encoding and packing of documents.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
