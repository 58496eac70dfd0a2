"""Continuous landing."""
