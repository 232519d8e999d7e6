"""Structured Streaming versions of the batch stages (L1, L2)."""
