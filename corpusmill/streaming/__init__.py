"""Structured Streaming forms of the batch operators, each idempotent by batch id."""
