"""Sources: SQL/JDBC scans, the stored day slices, and test vendor views."""

from .query import JdbcSource, scan_sql_query, source_frame
from .store import (comparable_tables, list_loaded_tables, scan_load_date,
                    scan_snapshot_table, slice_path, table_path)

__all__ = ["JdbcSource", "scan_sql_query", "source_frame", "comparable_tables",
           "list_loaded_tables", "scan_load_date", "scan_snapshot_table",
           "slice_path", "table_path"]
