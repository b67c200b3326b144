"""Operators for training-data pipelines. Nothing else in the library imports this package."""

from textpulse.llm.queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
