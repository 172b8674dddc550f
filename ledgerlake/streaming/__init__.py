"""Structured Streaming: keyed JSON feeds (S8-S10, K9) and the stream
queries R1-R6."""
