"""Structured Streaming: the three layers and the live counters."""
