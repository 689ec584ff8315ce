"""Sinks: day slices, snapshots, schema sidecar, audit rows, reports."""

from .writers import (append_audit, audit_row, read_audit, read_sidecar, sidecar_frame,
                      write_sidecar, write_slice, write_snapshot)

__all__ = ["append_audit", "audit_row", "read_audit", "read_sidecar", "sidecar_frame",
           "write_sidecar", "write_slice", "write_snapshot"]
