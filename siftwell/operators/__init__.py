"""Relational operators of curation pipelines."""
