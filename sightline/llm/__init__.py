"""Operators of a training-data pipeline over web-scale text.

Nothing outside this folder and ``corpus_pipeline.py`` imports it. Each module
holds one operator with its own general interface; ``catalog.py`` registers the
thin ``opN_<name>`` queries that derive their digest columns from it.
"""
