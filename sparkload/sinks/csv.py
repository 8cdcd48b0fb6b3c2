"""CSV dialect of the output files and its read-back.

Header, comma, minimal quoting with doubled quotes, null and empty both as
an empty field, strings untrimmed, timestamps as ``yyyy-MM-dd HH:mm:ss``
with microseconds.  Read back with ``multiLine`` because a kept ``\\r`` may
sit inside a quoted field.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Written with six decimals always; the fixed pattern gives the same bytes
# as an optional ``[.SSSSSS]`` section and formats faster (a whole-table
# write spends about a third of its time on timestamps).  Reading accepts
# the fraction as optional.
WRITE_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
DATE_FORMAT = "yyyy-MM-dd"

CSV_WRITE_OPTIONS: dict[str, str] = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": WRITE_TIMESTAMP_FORMAT,
    "timestampNTZFormat": WRITE_TIMESTAMP_FORMAT,
    "dateFormat": DATE_FORMAT,
}

CSV_READ_OPTIONS: dict[str, str] = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": TIMESTAMP_FORMAT,
    "timestampNTZFormat": TIMESTAMP_FORMAT,
    "dateFormat": DATE_FORMAT,
    "mode": "FAILFAST",
}

# A single output file funnels the table through one task; only frames
# counted at or below this many rows may ask for it.
DEFAULT_MAX_SINGLE_FILE_ROWS = 1_000_000


def csv_ready(df: DataFrame) -> DataFrame:
    """Types CSV cannot hold: binary → base64 text, nested → JSON text, void →
    empty text."""
    cols = []
    for f in df.schema.fields:
        col = df[f"`{f.name}`"]
        if isinstance(f.dataType, T.BinaryType):
            col = F.base64(col).alias(f.name)
        elif isinstance(f.dataType, T.NullType):
            col = col.cast("string").alias(f.name)
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            col = F.to_json(col).alias(f.name)
        cols.append(col)
    return df.select(*cols)


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    single_file: bool = False,
    row_count: int | None = None,
    max_single_file_rows: int = DEFAULT_MAX_SINGLE_FILE_ROWS,
) -> bool:
    """Write ``df`` as a CSV directory at ``path``.

    ``single_file`` collapses the output to one part file, written by one
    task.  A frame whose row count (given, or counted here) is above
    ``max_single_file_rows`` is refused before anything is written; the
    layout never depends on the size.  Returns whether one file was written.
    """
    out = csv_ready(df)
    if single_file:
        n = out.count() if row_count is None else row_count
        if n > max_single_file_rows:
            raise ValueError(f"{n} rows are too many for a single file (at most {max_single_file_rows}): {path}")
        out = out.coalesce(1)
    options = dict(CSV_WRITE_OPTIONS)
    if len(out.columns) == 1:
        # A lone empty field is an empty line, which readers skip: quote it.
        options |= {"nullValue": '""', "emptyValue": '""'}
    out.write.mode(mode).options(**options).csv(path)
    return single_file


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read an output directory back with an explicit schema (no inference)."""
    return spark.read.schema(schema).options(**CSV_READ_OPTIONS).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Columnar alternative for large tables (splittable, typed)."""
    df.write.mode(mode).parquet(path)
