"""Readers and writers: landed payloads, the taxonomy seed, stored tables."""
