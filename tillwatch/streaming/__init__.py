"""Structured Streaming: stores, micro-batch handlers, queries and their monitoring."""
