"""Readers and writers, with their options fixed in one place."""

from tarn.sources.month import land_month, read_month
from tarn.sources.pages import read_pages
from tarn.sources.paths import LakePaths, listed_bytes, scratch_folder
from tarn.sources.published import (
    IncompleteRun,
    newest,
    newest_per_stamp,
    run_folders,
    run_records,
)
from tarn.sources.tables import (
    append_rows,
    local_rows,
    read_rows,
    read_table,
    write_partitioned,
    write_table,
)

__all__ = [
    "IncompleteRun",
    "LakePaths",
    "append_rows",
    "land_month",
    "listed_bytes",
    "local_rows",
    "newest",
    "newest_per_stamp",
    "read_month",
    "read_pages",
    "read_rows",
    "read_table",
    "run_folders",
    "run_records",
    "scratch_folder",
    "write_partitioned",
    "write_table",
]
