"""Composed jobs: feature tables, evaluation and risk products."""
