"""Sources, sinks, declared schemas and catalog helpers."""

from stagewise.sources.schemas import SCHEMAS, TABLE_COMMENTS
from stagewise.sources.readers import (
    read_declared_csv, read_text_export, read_table, infer_numeric, run_sql,
)
from stagewise.sources.catalog import (
    list_tables, row_counts, columns_of, preview, publish_view, read_view,
)
from stagewise.sources.sinks import write_csv, write_bucketed

__all__ = [
    "SCHEMAS", "TABLE_COMMENTS", "read_declared_csv", "read_text_export", "read_table",
    "infer_numeric", "run_sql", "list_tables", "row_counts", "columns_of", "preview",
    "publish_view", "read_view", "write_csv", "write_bucketed",
]
