"""Structured Streaming: starting queries, fan-out, running totals."""
