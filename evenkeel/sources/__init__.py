"""Readers and writers."""

from evenkeel.sources.files import (
    GroupReport,
    Landing,
    infer_types,
    land_csv,
    malformed_rows,
    read_csv,
    read_parquet,
    write_report,
    write_splits,
    write_table,
)
from evenkeel.sources.shared import materialize, shared_dir

__all__ = [
    "GroupReport", "Landing", "infer_types", "land_csv", "malformed_rows", "materialize", "read_csv", "read_parquet",
    "shared_dir", "write_report", "write_splits", "write_table",
]
