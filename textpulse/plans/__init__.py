"""Whole flows: model training, scoring, text analysis."""
