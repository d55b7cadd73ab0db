"""Structured Streaming twins of the batch event operators, and stream sinks."""
