"""Operators for building training corpora: filtering, deduplication, scoring, packing and archives.

Self-contained: nothing outside this package (except ``corpus_pipeline.py``) imports it.
"""
