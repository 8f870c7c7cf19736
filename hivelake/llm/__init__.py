"""Operators for training-data pipelines: filters, scoring, deduplication and tokenisation.

Nothing else in the library imports this subpackage.  Every operator takes a DataFrame and the names of
the columns it works on; columns that it does not name are ignored, whatever they are called.
"""
