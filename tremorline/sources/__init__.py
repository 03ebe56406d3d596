from tremorline.sources.landing import read_landing, rejected, write_landing
from tremorline.sources.paths import Run
from tremorline.sources.silver import read_silver, write_silver
from tremorline.sources.cells import read_cells, write_cells
from tremorline.sources.table import (
    append_shape,
    append_table,
    conform,
    conform_losses,
    has_run,
    latest_day,
    merged_schema,
    read_run,
    read_shapes,
    read_table,
    united,
    whole_runs,
)

__all__ = [
    "Run",
    "append_shape",
    "append_table",
    "conform",
    "conform_losses",
    "has_run",
    "latest_day",
    "merged_schema",
    "read_cells",
    "read_landing",
    "read_silver",
    "read_run",
    "read_shapes",
    "read_table",
    "rejected",
    "united",
    "whole_runs",
    "write_cells",
    "write_landing",
    "write_silver",
]
