"""Operators and queries that prepare text corpora for language-model training."""
