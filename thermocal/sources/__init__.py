"""Sources, sinks and parameter tables."""

from thermocal.sources.readings import (  # noqa: F401
    array_to_columns, read_readings, read_table, require_columns, rows_to_frame,
)
