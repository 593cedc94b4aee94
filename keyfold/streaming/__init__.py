"""Structured Streaming: one checkpointed query per table, plus continuous views."""
