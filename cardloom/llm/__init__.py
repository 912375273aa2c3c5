"""Operators for training-data corpora: text, embeddings and pages."""
