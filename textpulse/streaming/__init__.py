"""Structured Streaming: paced replay, stateless scoring, repeatable batch sinks."""
