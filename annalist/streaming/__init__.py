"""Structured Streaming counterparts, beyond the batch reference."""
