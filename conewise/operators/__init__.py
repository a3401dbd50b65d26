"""Distributed rank, per-key windows and multi-step aggregates."""
