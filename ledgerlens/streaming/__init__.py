"""Structured Streaming: windows, behavioural state, deduplication, lifecycle."""
