"""Pipelines: daily loads and reconciliations composed from the operators."""
