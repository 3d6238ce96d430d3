"""Operators for training-data corpora: classifiers, deduplication, decontamination, PII, HTML, tokens."""
