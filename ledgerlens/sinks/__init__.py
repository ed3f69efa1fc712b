"""Batch and stream sinks."""
