"""Operators of a training-data pipeline: one module per operator.

``registry`` lists their queries and SQL. Nothing outside this folder (and
``corpus_pipeline.py``) imports it.
"""
