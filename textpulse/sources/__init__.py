"""Readers and writers: delimited text, JSON messages, tables, logs and models."""
