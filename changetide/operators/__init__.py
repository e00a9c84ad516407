"""Operators on change frames, change logs and table snapshots."""

from .checksum import reconcile_by_checksum
from .decode import changes, classify, decode, reject_summary, rejects, to_messages
from .merge import (
    cascade_delete, insert_if_absent, merge_delete, merge_upsert, one_per_key, update_where,
)
from .reconcile import reconcile, reconcile_summary, verify_key, verify_rows
from .state import as_of, current, last_changes, lookup, published, up_to, versions
from .timeline import batch_metrics, history, last_operations, version_row_counts

__all__ = [
    "as_of", "batch_metrics", "cascade_delete", "changes", "classify", "current", "decode",
    "history", "insert_if_absent", "last_changes", "last_operations", "lookup", "merge_delete",
    "merge_upsert", "one_per_key", "published", "reconcile", "reconcile_by_checksum", "reconcile_summary", "reject_summary", "rejects",
    "to_messages", "up_to", "update_where", "verify_key", "verify_rows",
    "version_row_counts", "versions",
]
