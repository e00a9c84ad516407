"""Streams into change logs, and the stored logs."""

from .changelog import ChangeLog, consistent_cut
from .queries import await_all, progress, start, start_all, stop_all
from .together import cascade_delete_logged, commit_together
from .writer import make_batch_writer, write_snapshot

__all__ = ["ChangeLog", "await_all", "cascade_delete_logged", "commit_together", "consistent_cut", "make_batch_writer",
           "progress", "start", "start_all", "stop_all", "write_snapshot"]
