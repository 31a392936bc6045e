"""Sinks: the bronze snapshot store and its load log."""

from tidemark.sinks.store import Snapshot, TableStore

__all__ = ["Snapshot", "TableStore"]
