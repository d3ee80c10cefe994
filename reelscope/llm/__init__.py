"""Operators for preparing training corpora, one module per operator.

Nothing outside this folder imports it, apart from ``corpus_pipeline.py``
and the guarded lookup in ``__spark_entry__.py``.
"""
