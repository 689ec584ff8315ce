"""Scalar rules as Spark column expressions (no UDFs)."""

from .cast import cast_declared, check_write_schema, narrows
from .compare import abs_difference, null_mismatch, values_equal
from .fill import fill_float, fill_int, fill_string
from .timefmt import (change_day_int, day_bounds, day_text, load_date_of,
                      to_epoch_seconds, yesterday)
from .types import logical_type, parquet_type

__all__ = ["cast_declared", "check_write_schema", "narrows", "abs_difference",
           "null_mismatch", "values_equal", "fill_float", "fill_int", "fill_string",
           "change_day_int", "day_bounds", "day_text", "load_date_of",
           "to_epoch_seconds", "yesterday", "logical_type", "parquet_type"]
