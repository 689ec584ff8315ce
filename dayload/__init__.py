"""dayload: daily vendor-table loads and load reconciliation on Spark."""

from .catalog import ColumnSpec, TableSpec
from .session import build_session, checkpoint_root

__all__ = ["ColumnSpec", "TableSpec", "build_session", "checkpoint_root"]
