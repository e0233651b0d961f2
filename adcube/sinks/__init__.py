"""Sinks: full refresh and keyed upsert with schema policies."""

from .table import max_date, merge_by_key, publish, read_table, recover, upsert_by_key, write_table

__all__ = ["max_date", "merge_by_key", "publish", "read_table", "recover", "upsert_by_key", "write_table"]
