"""Writers: overwrite, append by name, replace rows or partitions, CSV export."""

from entwise.sinks.writers import (  # noqa: F401
    append_by_name, append_or_create, export_csv, overwrite, replace_partitions, replace_rows,
)
