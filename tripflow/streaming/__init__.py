"""Structured Streaming jobs; the window functions work on batch tables alike."""
