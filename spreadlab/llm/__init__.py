"""Operators for preparing training text, and the queries that apply them.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
