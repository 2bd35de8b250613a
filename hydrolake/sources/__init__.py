"""Readers and writers of bronze, silver and gold tables."""

from hydrolake.sources.files import (
    inventory, read_footers, read_lookup, read_pages, read_payloads, read_registry, read_run_logs,
    read_snapshots, run_log_fields, write_long, write_snapshots,
)

__all__ = [n for n in dir() if not n.startswith("_")]
