"""Operators for preparing training text at scale: quality rules, deduplication, mixing, language
identification, packing, chat formatting and text classifiers.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
