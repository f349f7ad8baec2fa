"""Writers for results of any size."""

from gristmill.sinks.files import (
    preview_lines,
    write_key_values,
    write_preview,
    write_report,
    write_reports,
    write_snapshot,
    write_table,
)

__all__ = [
    "preview_lines",
    "write_key_values",
    "write_preview",
    "write_report",
    "write_reports",
    "write_snapshot",
    "write_table",
]
