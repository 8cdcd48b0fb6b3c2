"""Sinks K1-K6: path rules and the CSV dialect."""

from .csv import CSV_READ_OPTIONS, CSV_WRITE_OPTIONS, csv_ready, read_csv, write_csv, write_parquet
from .paths import Layout, folder_for_schema, output_path, write_mode
from .publish import current_path, publish, publish_all, settle, staged_path

__all__ = [
    "CSV_READ_OPTIONS",
    "CSV_WRITE_OPTIONS",
    "Layout",
    "csv_ready",
    "current_path",
    "folder_for_schema",
    "output_path",
    "publish",
    "publish_all",
    "read_csv",
    "settle",
    "staged_path",
    "write_csv",
    "write_mode",
    "write_parquet",
]
