"""Structured Streaming jobs (K1-K4)."""
