"""Topics, tables and work folders."""

from marketflow.sources.bucketed import create_bucketed_klines, insert_bucketed, read_bucketed
from marketflow.sources.lookup import lookup_rows, summarize_files
from marketflow.sources.numbered import NumberedTopics, with_offsets
from marketflow.sources.published import publish_table, read_published, replaced_dates
from marketflow.sources.tables import (
    append_rows,
    compact_table,
    create_tables,
    insert_rows,
    read_compacted,
    read_quarantine,
    read_table,
    register_views,
    stored_positions,
    table_rows,
)
from marketflow.sources.topics import FileTopics, KafkaTopics, Rate, published_flush, published_rate
from marketflow.sources.work import new_work_dir

__all__ = [
    "FileTopics",
    "KafkaTopics",
    "NumberedTopics",
    "Rate",
    "append_rows",
    "compact_table",
    "create_bucketed_klines",
    "create_tables",
    "insert_bucketed",
    "insert_rows",
    "lookup_rows",
    "new_work_dir",
    "publish_table",
    "published_flush",
    "published_rate",
    "read_bucketed",
    "read_compacted",
    "read_published",
    "read_quarantine",
    "read_table",
    "register_views",
    "replaced_dates",
    "stored_positions",
    "summarize_files",
    "table_rows",
    "with_offsets",
]
