"""Registered queries. Importing the modules fills the registry."""

from textpulse.suite import features, lookups, models, records, streams, tables, text
from textpulse.suite.registry import QUERIES, SQL

__all__ = [
    "QUERIES",
    "SQL",
    "features",
    "lookups",
    "models",
    "records",
    "streams",
    "tables",
    "text",
]
