"""Writers: Parquet tables, CSV landing files, run snapshots with manifest."""

from tillroll.sinks.files import write_csv, write_parquet  # noqa: F401
