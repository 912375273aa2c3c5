"""Fraud classifier: features, training, scoring, drift."""
