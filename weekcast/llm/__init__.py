"""Operators for large text corpora: ten pipeline operators and their registered queries.

Nothing outside this folder (but for the guarded lookup in ``__spark_entry__.py`` and
``corpus_pipeline.py``) imports it.
"""
