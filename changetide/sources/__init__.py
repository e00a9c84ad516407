"""Message sources, bulk files, and the paths behind them."""

from .bulk import (
    as_rejects, bootstrap, csv_rejects, load_csv, load_shop_tables, number_rows, replace_table, shop_rejects, to_changes,
)
from .envelope import flatten_envelope
from .messages import file_messages, kafka_messages, route, text_messages
from .segments import segment_messages, write_segments
from .paths import data_files, entries, exists, first_existing, scratch_dir, written

__all__ = [
    "as_rejects", "bootstrap", "csv_rejects", "data_files", "entries", "exists", "file_messages", "first_existing", "flatten_envelope",
    "kafka_messages", "load_csv", "load_shop_tables", "number_rows", "replace_table", "route",
    "scratch_dir", "segment_messages", "shop_rejects", "text_messages", "to_changes", "write_segments", "written",
]
