"""Operators of a training-data pipeline over web-scale text corpora.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
Every operator takes DataFrames and returns DataFrames, selects only the
columns it names (extra columns, whatever their names, are ignored) and
writes intermediate tables to the session's shared checkpoint folder.
"""
