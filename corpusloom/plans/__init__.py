"""Pipelines: rendering, gating and model calls."""
