"""Readers and writers."""

from .tables import publish, publish_staged, read_clean, read_raw, read_star, write_report, write_table  # noqa: F401
