"""Output path rules (K1-K6).

Each reference file ``.../T<stamp>.csv`` becomes a directory of that name
holding Spark part files, written in parallel by the tasks and committed
atomically by the output committer.
"""

from __future__ import annotations

from enum import Enum

from ..context import RunContext, join_path

# Top-level folders, kind sub-folders and the file extension.
DATABASE_ROOT = "mysql_backups"
RECORDS_ROOT = "salesforce_backups"
INSERT_FOLDER = "insert"
UPDATE_FOLDER = "update"
DISTINCT_FOLDER = "distinct"
DAILY_INCR_FOLDER = "daily_incr"
FILE_EXTENSION = ".csv"


class Layout(str, Enum):
    SNAPSHOT = "snapshot"      # K1 DB/T/T<yyyymmdd>.csv, same-day overwrite
    INSERT = "insert"          # K2 DB/T/insert/T<yyyymmdd>.csv
    UPDATE = "update"          # K3 DB/T/update/T<yyyymmdd>.csv
    DISTINCT = "distinct"      # K4 DB/T/distinct/T<yyyymmdd>.csv
    DAILY_INCR = "daily_incr"  # K5 DB/daily_incr/t/t<yyyymmddHHMMSS>.csv, new per run
    RECORDS = "records"        # K6 salesforce_backups/T/T<yyyymmdd>.csv


_KIND_FOLDER = {
    Layout.INSERT: INSERT_FOLDER,
    Layout.UPDATE: UPDATE_FOLDER,
    Layout.DISTINCT: DISTINCT_FOLDER,
}


def folder_for_schema(schema: str) -> str:
    """Output folder of a source schema: ``billing-service`` → ``billing_service``."""
    return schema.replace("-", "_")


def output_path(ctx: RunContext, layout: Layout | str, folder: str, table: str) -> str:
    """Full output path of one table for this run."""
    layout = Layout(layout)
    if layout is Layout.RECORDS:
        return join_path(ctx.output_root, RECORDS_ROOT, table, f"{table}{ctx.day_stamp}{FILE_EXTENSION}")
    if layout is Layout.DAILY_INCR:
        name = table.lower()
        return join_path(ctx.output_root, DATABASE_ROOT, folder, DAILY_INCR_FOLDER, name,
                         f"{name}{ctx.run_stamp}{FILE_EXTENSION}")
    file_name = f"{table}{ctx.day_stamp}{FILE_EXTENSION}"
    sub = _KIND_FOLDER.get(layout)
    parts = [DATABASE_ROOT, folder, table] + ([sub] if sub else []) + [file_name]
    return join_path(ctx.output_root, *parts)


def write_mode(layout: Layout | str) -> str:
    """Dated files are replaced by a same-day rerun; per-run files must be new."""
    return "errorifexists" if Layout(layout) is Layout.DAILY_INCR else "overwrite"
