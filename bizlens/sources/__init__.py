"""Scans and sinks (inventory section A)."""

from .tables import DRIVER_TABLES, load_tables, read_table  # noqa: F401
