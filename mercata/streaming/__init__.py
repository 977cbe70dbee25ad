"""Counters kept fresh as orders arrive."""
