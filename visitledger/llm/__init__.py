"""Operators of a training-data pipeline: quality, duplicates, secrets, licences, URLs, mixing and tokens.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
