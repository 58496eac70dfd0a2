"""Distributed operators that more than one model needs."""
