"""Incremental and streaming use."""
