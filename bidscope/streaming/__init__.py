"""Structured Streaming jobs over the same KPI definitions."""
