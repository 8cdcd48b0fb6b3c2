"""Load report (G5): one row per extract with rows written and status."""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession

from ..context import local_frame

REPORT_SCHEMA = (
    "job string, schema_name string, table_name string, layout string, path string, "
    "rows long, status string, error string, seconds double"
)

OK = "ok"
MISSING = "missing"        # not in the source catalog: skipped, as the reference does
ERROR = "error"            # read or write failed; other tables go on
SKIPPED = "skipped"        # a child whose parent failed


@dataclass
class LoadResult:
    job: str
    schema_name: str
    table_name: str
    layout: str
    path: str | None
    rows: int | None
    status: str
    error: str | None = None
    seconds: float | None = None


def lost(result: LoadResult) -> bool:
    """An extract that should have a file and has none.  A table missing from
    its catalog is no loss, nor are the children of one."""
    return result.status == ERROR or (result.status == SKIPPED and not (result.error or "").endswith(" missing"))


def report_frame(spark: SparkSession, results: list[LoadResult]) -> DataFrame:
    """The report as a frame (one row per manifest entry; bounded)."""
    return local_frame(spark, [astuple(r) for r in results], REPORT_SCHEMA)
