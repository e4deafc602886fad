"""Structured Streaming consumption of change logs and the outbox protocol."""
