"""Operators for building training corpora at scale.

Nothing outside this package imports it.  ``dayload.llm.queries`` registers one
query per operator; ``corpus_pipeline.py`` at the repository top chains five of
them.
"""
