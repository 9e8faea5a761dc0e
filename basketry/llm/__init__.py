"""Corpus operators for training data: packing, dedup, scoring, archives, quality, language."""
