"""Operators of a training-data pipeline over documents, pages and conversations.

Nothing else in the library imports this package. Every operator takes frames and
column names, keeps only the columns it names (so further columns, whatever they are
called, cannot clash with its own) and returns a lazy frame; intermediate tables go to
the shared folder in ``spark.checkpoint.dir``.
"""
