"""Operators for large text corpora: thirteen building blocks of a training-data pipeline.

Every operator takes and returns DataFrames; ``queries.py`` registers one
query per operator over the ``documents`` (or ``pages``) table.
"""
