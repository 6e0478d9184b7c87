"""Sources and sinks: lake tables, raw text and delimited files, adapters."""

from transitlake.sources.lake import (
    Lake,
    checkpoint_dir,
    read_delimited,
    read_lines,
    shared_root,
    write_delimited,
    write_lines,
)

__all__ = [
    "Lake",
    "checkpoint_dir",
    "read_delimited",
    "read_lines",
    "shared_root",
    "write_delimited",
    "write_lines",
]
