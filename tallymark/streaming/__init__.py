"""Structured Streaming forms: windows with watermarks, change state, idempotent overwrites.

These are the engine's own; the operators they extend are batch.
"""
