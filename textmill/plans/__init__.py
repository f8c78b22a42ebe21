"""Whole dataflows."""
