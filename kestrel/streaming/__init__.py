"""Structured Streaming jobs (sources, running state, windowed error, risk flags, scoring)."""
