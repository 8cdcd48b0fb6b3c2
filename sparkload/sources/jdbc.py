"""JDBC reads (S1, S2, S7 and the source-side derived column of P4).

A table is read by parallel range queries on a key; simple
comparisons of the window predicates are pushed into each query's
``WHERE``.  Ranges are equal strides of ``[min, max]`` (Spark's
``partitionColumn``) or, with ``balance="quantiles"``, tiles of equal row
count computed by the source, so an unevenly spread key (a dense id range
holding a third of the rows) does not become one task.  Tiles take any key the
source can order: texts, dates, several columns.  ``balance="hash"`` deals rows
out by a hash that the source computes, for keys that it cannot tile.
A table without a plan is read by its primary key (``read_by_key``).
Aggregates are not pushed by the V1 JDBC
reader, so the one-row watermark and the partition bounds are fetched with
the ``query`` option instead: the source computes them and returns one row.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


# Rows per round trip of a JDBC read (see DEFAULT_READ_OPTIONS).
DEFAULT_FETCH_SIZE = 10_000
BALANCES = ("stride", "quantiles", "hash")
# Rows of one range of a read by primary key, at least.
ROWS_PER_RANGE = 100_000
# Hash of a key in MySQL; other sources name theirs (``hash_sql``).
MYSQL_HASH = "mod(crc32(concat_ws('|', {key})), {n})"

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class JdbcPartitioning:
    """Parallel read plan of one table.

    ``column`` is the key: a column, or several (tiles and hashes only).

    ``balance="stride"``: ``num_partitions`` equal strides of
    ``[lower, upper]``; bounds left ``None`` are fetched from the source
    with one ``min``/``max`` query.  ``balance="quantiles"``: the source
    splits the key into ``num_partitions`` tiles of equal row count
    (``ntile``, a window function of MySQL 8 and most warehouses) and
    returns the first key of each; one range per tile is read.  Use a
    unique key (the primary key): rows sharing one key value always fall
    into one range.  ``balance="hash"``: ``num_partitions`` queries, each with
    the rows whose ``hash_sql`` (of ``{key}``, modulo ``{n}``, never null) has
    its number; each query scans the table, so tiles are better where the
    source can compute them.
    """

    column: str | tuple[str, ...]
    num_partitions: int
    lower: int | None = None
    upper: int | None = None
    fetch_size: int = DEFAULT_FETCH_SIZE
    balance: str = "stride"
    hash_sql: str = MYSQL_HASH

    def __post_init__(self):
        if self.balance not in BALANCES:
            raise ValueError(f"balance must be one of {BALANCES}, not {self.balance!r}")
        if isinstance(self.column, list):  # of a JSON document
            object.__setattr__(self, "column", tuple(self.column))
        if self.balance == "stride" and not isinstance(self.column, str):
            raise ValueError("equal strides need one column")

    @property
    def key(self) -> tuple[str, ...]:
        return (self.column,) if isinstance(self.column, str) else self.column


def quote_ident(name: str, quote: str = "`") -> str:
    """Quote an identifier (MySQL back-ticks by default; ``"`` for ANSI)."""
    return f"{quote}{name.replace(quote, quote * 2)}{quote}"


def derived_subquery(table: str, derived: Mapping[str, str], quote: str = "`") -> str:
    """``dbtable`` text that evaluates source-side functions (P4/X9):
    ``(select *, f(a, b) as net_impact from t) q``.  It still supports a
    partitioned read, since Spark wraps it in range predicates."""
    extra = "".join(f", {expr} as {quote_ident(name, quote)}" for name, expr in derived.items())
    return f"(select *{extra} from {quote_ident(table, quote)}) sparkload_q"


def bounds_query(table_sql: str, column: str, quote: str = "`") -> str:
    c = quote_ident(column, quote)
    return f"select min({c}) as lo, max({c}) as hi from {table_sql}"


def tiles_query(table_sql: str, column: str | Sequence[str], tiles: int, quote: str = "`") -> str:
    """First key of each of ``tiles`` tiles of equal row count, in the source's
    own order (one row per tile: the key's columns, then the tile's number;
    keys with nulls left out)."""
    key = [quote_ident(c, quote) for c in ([column] if isinstance(column, str) else column)]
    own, order = [f"k{i}" for i in range(len(key))], ", ".join(key)
    return (f"select {', '.join(own)}, tile from (select {', '.join(own)}, tile, "
            f"row_number() over (partition by tile order by {', '.join(own)}) as place from "
            f"(select {', '.join(f'{c} as {k}' for c, k in zip(key, own))}, ntile({int(tiles)}) over (order by {order}) as tile "
            f"from {table_sql} where {' and '.join(f'{c} is not null' for c in key)}) sparkload_t) sparkload_u where place = 1")


def sql_literal(value) -> str:
    """A key value as SQL text."""
    if isinstance(value, bool):
        raise TypeError("boolean keys cannot be range-partitioned")
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return "'" + (value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()) + "'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, (bytes, bytearray)):
        return f"x'{value.hex()}'"
    raise TypeError(f"no SQL literal for key value of type {type(value).__name__}")


def range_predicates(column: str, cuts: Sequence, quote: str = "`") -> list[str]:
    """``WHERE`` clauses of the ranges between cut points: below the first
    (with null keys), between neighbours, and from the last up.  The ranges
    are disjoint and together hold every row.  Cut points are put in Python's
    order; for texts, whose order is the source's, see ``key_predicates``."""
    return key_predicates((column,), [(v,) for v in sorted(set(cuts))], quote)


def key_predicates(key: Sequence[str], cuts: Sequence[tuple], quote: str = "`") -> list[str]:
    """``range_predicates`` of a key of one or more columns, compared column
    by column.  ``cuts`` are in the source's order, which may be a collation of
    its own: every comparison is the source's, so the ranges are disjoint and
    complete under that order.  The leading column bounds each range by
    itself, which an index can use."""
    cols = [quote_ident(c, quote) for c in key]
    points = [p for p, before in zip(cuts, [None, *cuts]) if p != before]
    if not points:
        return []

    def beyond(point: tuple, strict: str, last: str, at: int = 0) -> str:
        c, v = cols[at], sql_literal(point[at])
        if at == len(cols) - 1:
            return f"{c} {last} {v}"
        return f"{c} {strict}= {v} and ({c} {strict} {v} or {beyond(point, strict, last, at + 1)})"

    low, high = [beyond(p, ">", ">=") for p in points], [beyond(p, "<", "<") for p in points]
    some = "".join(f" and {c} is not null" for c in cols[1:])
    preds = [f"{high[0] if len(cols) == 1 else f'({high[0]})'} or " + " or ".join(f"{c} is null" for c in cols)]
    preds += [f"{a} and {b}{some}" for a, b in zip(low, high[1:])]
    preds.append(f"{low[-1]}{some}")
    return preds


def hash_predicates(partitioning: JdbcPartitioning, quote: str = "`") -> list[str]:
    """``WHERE`` clauses that deal rows out by a hash of the key."""
    key = ", ".join(quote_ident(c, quote) for c in partitioning.key)
    h = partitioning.hash_sql.format(key=key, n=partitioning.num_partitions)
    return [f"{h} = {i}" for i in range(partitioning.num_partitions)]


def quantile_predicates(spark: SparkSession, base: Mapping[str, str], table_sql: str,
                        partitioning: JdbcPartitioning, quote: str = "`") -> list[str]:
    """Range predicates of equal row count, from one source-side query whose
    result has ``num_partitions`` rows at most; the tiles' numbers keep the
    source's order."""
    tiles = query_one_row(spark, base, tiles_query(table_sql, partitioning.key, partitioning.num_partitions, quote)).collect()
    n = len(partitioning.key)  # by position: sources may fold aliases
    firsts = [tuple(r)[:n] for r in sorted(tiles, key=lambda r: r[n])]
    return key_predicates(partitioning.key, firsts[1:], quote)


def primary_key_query(schema: str, table: str) -> str:
    """Columns of a table's primary key, with their position (standard
    ``information_schema``; the result has one row per key column)."""
    def text(v: str) -> str:
        return "'" + v.replace("'", "''") + "'"
    return ("select k.column_name as column_name, k.ordinal_position as ordinal_position "
            "from information_schema.table_constraints c join information_schema.key_column_usage k "
            "on k.constraint_name = c.constraint_name and k.table_schema = c.table_schema "
            "and k.table_name = c.table_name "
            f"where c.constraint_type = 'PRIMARY KEY' and c.table_schema = {text(schema)} "
            f"and c.table_name = {text(table)}")


def marks_query(table_sql: str, created: str, updated: str, quote: str = "`") -> str:
    """The watermark computed in the source; one row comes back."""
    return (f"select max({quote_ident(created, quote)}) as max_created_at, "
            f"max({quote_ident(updated, quote)}) as max_updated_at from {table_sql}")


def catalog_query(schema: str, names: list[str] | None = None, fold_case: bool = False) -> str:
    """``information_schema.tables`` rows of one schema, optionally
    restricted to an allow-list (pushed to the source).  With ``fold_case``
    schema and names are compared in upper case: a warehouse keeps unquoted
    names upper case (``SMC``, ``ASSET``) while the manifest spells them in
    lower case."""
    def text(v: str) -> str:
        return "'" + (v.upper() if fold_case else v).replace("'", "''") + "'"

    schema_col, name_col = ("upper(table_schema)", "upper(table_name)") if fold_case else ("table_schema", "table_name")
    sql = f"select table_schema, table_name from information_schema.tables where {schema_col} = {text(schema)}"
    if names:
        sql += f" and {name_col} in ({', '.join(text(n) for n in names)})"
    return sql


# Source DATETIME columns carry no zone; reading them as timestamp_ntz keeps
# window comparisons free of session-zone conversions.  Rows arrive in
# batches of ``fetchsize``, which bounds a task's memory whatever the size
# of its range (also for tables read whole).
DEFAULT_READ_OPTIONS = {"preferTimestampNTZ": "true", "fetchsize": str(DEFAULT_FETCH_SIZE)}

# MySQL Connector/J connection properties.  ``useCursorFetch``: the driver
# honours ``fetchsize`` only with a server-side cursor; without it each task
# holds its whole result set in memory.  The others read values as the
# reference's Python driver returns them: TINYINT(1) flags as 0/1 integers
# (not booleans), YEAR as a number (not a date), zero dates as null (not an
# error).
MYSQL_READ_OPTIONS = {
    "useCursorFetch": "true",
    "tinyInt1isBit": "false",
    "yearIsDateType": "false",
    "zeroDateTimeBehavior": "CONVERT_TO_NULL",
}


def source_defaults(base: Mapping[str, str]) -> dict[str, str]:
    """Default options for the source named by ``base["url"]``; options in
    ``base`` override them."""
    opts = dict(DEFAULT_READ_OPTIONS)
    if str(base.get("url", "")).startswith("jdbc:mysql:"):
        opts.update(MYSQL_READ_OPTIONS)
    return {**opts, **base}


def reader_options(
    base: Mapping[str, str],
    dbtable: str,
    partitioning: JdbcPartitioning | None = None,
    bounds: tuple[int, int] | None = None,
) -> dict[str, str]:
    """Options of ``spark.read.format('jdbc')`` for one table."""
    opts = source_defaults(base)
    opts["dbtable"] = dbtable
    if partitioning is not None:
        lo = partitioning.lower if partitioning.lower is not None else (bounds[0] if bounds else None)
        hi = partitioning.upper if partitioning.upper is not None else (bounds[1] if bounds else None)
        opts["fetchsize"] = str(partitioning.fetch_size)
        if lo is not None and hi is not None and hi > lo and partitioning.num_partitions > 1:
            opts.update(
                partitionColumn=partitioning.column,
                lowerBound=str(lo),
                upperBound=str(hi),
                numPartitions=str(partitioning.num_partitions),
            )
    return opts


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Types of keys that can be tiled.  Not timestamps of an instant: as wall clock
# of the driver's zone they do not keep the source's order.
_ORDERED = (T.IntegralType, T.DecimalType, T.StringType, T.DateType, T.TimestampNTZType, T.BinaryType)


def partitionable(partitioning: JdbcPartitioning, schema: T.StructType) -> bool:
    """Whether ``schema`` has the partitioning column with an integral type
    (case-insensitive, as the source resolves names)."""
    for f in schema.fields:
        if f.name.lower() == partitioning.key[0].lower():
            t = f.dataType
            return isinstance(t, _INTEGRAL) or (isinstance(t, T.DecimalType) and t.scale == 0)
    return False


def key_partitioning(key: Sequence[str], schema: T.StructType, num_partitions: int) -> JdbcPartitioning | None:
    """The plan of a table's primary key: equal strides of one whole number,
    else tiles over all of its columns; ``None`` for a key that cannot be cut."""
    types = {f.name.lower(): f.dataType for f in schema.fields}
    if not key or not all(isinstance(types.get(c.lower()), _ORDERED) for c in key):
        return None
    stride = JdbcPartitioning(key[0], num_partitions)
    if len(key) == 1 and partitionable(stride, schema):
        return stride
    return JdbcPartitioning(tuple(key), num_partitions, balance="quantiles")


def query_one_row(spark: SparkSession, base: Mapping[str, str], sql: str) -> DataFrame:
    """A query evaluated by the source (``query`` option)."""
    opts = {k: v for k, v in source_defaults(base).items() if k != "dbtable"}
    return spark.read.format("jdbc").options(**opts).option("query", sql).load()


def _load(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def _load_parts(spark: SparkSession, base: Mapping[str, str], dbtable: str, preds: list[str], fetch_size: int) -> DataFrame:
    """One read per predicate."""
    props = {**source_defaults(base), "fetchsize": str(fetch_size)}
    url = props.pop("url")
    props.pop("dbtable", None)
    return spark.read.jdbc(url, dbtable, predicates=preds, properties=props)


def _key_bounds(spark: SparkSession, base: Mapping[str, str], table_sql: str, column: str, quote: str) -> tuple[int, int] | None:
    row = query_one_row(spark, base, bounds_query(table_sql, column, quote)).first()
    return None if row is None or row[0] is None else (int(row[0]), int(row[1]))  # by position: sources may fold aliases


def read_by_key(spark: SparkSession, base: Mapping[str, str], table: str, key: Sequence[str], num_partitions: int,
                derived: Mapping[str, str] | None = None, quote: str = "`") -> DataFrame:
    """Read a table without a plan of its own by its primary key, in at most
    ``num_partitions`` ranges of at least ``ROWS_PER_RANGE`` rows (by the
    key's span for whole numbers, else counted), so small tables keep one
    connection.  A source that cannot compute tiles deals the rows out by hash
    where it is MySQL (whose versions before 8 have no window functions); any
    other is read whole, with a warning."""
    table_sql = quote_ident(table, quote)
    dbtable = derived_subquery(table, derived, quote) if derived else table_sql
    plain = _load(spark, reader_options(base, dbtable))
    plan = key_partitioning(key, plain.schema, num_partitions)
    if plan is None:
        return plain
    if plan.balance == "stride":
        bounds = _key_bounds(spark, base, table_sql, key[0], quote)
        parts = 1 if bounds is None else min(num_partitions, -(-(bounds[1] - bounds[0] + 1) // ROWS_PER_RANGE))
        if parts <= 1:
            return plain
        return _load(spark, reader_options(base, dbtable, replace(plan, num_partitions=parts), bounds))
    rows = int(query_one_row(spark, base, f"select count(*) as n from {table_sql}").first()[0])
    plan = replace(plan, num_partitions=max(1, min(num_partitions, -(-rows // ROWS_PER_RANGE))))
    if plan.num_partitions == 1:
        return plain
    try:
        preds = quantile_predicates(spark, base, table_sql, plan, quote)
    except Exception as e:
        if not str(base.get("url", "")).startswith("jdbc:mysql:"):
            log.warning("%s is read by one task: its key %s cannot be tiled (%s)", table, key, e)
            return plain
        preds = hash_predicates(replace(plan, balance="hash"), quote)
    return _load_parts(spark, base, dbtable, preds, plan.fetch_size) if len(preds) > 1 else plain


def read_table(
    spark: SparkSession,
    base: Mapping[str, str],
    table: str,
    partitioning: JdbcPartitioning | None = None,
    derived: Mapping[str, str] | None = None,
    quote: str = "`",
    check_column: bool = False,
) -> DataFrame:
    """Read one table, in parallel when ``partitioning`` is given.

    ``check_column`` (a source-wide default rather than a plan made for this
    table): partition only if the table has the key column with an integral
    type, else read it whole.  Resolving the schema is one metadata query
    that returns no rows.
    """
    dbtable = derived_subquery(table, derived, quote) if derived else quote_ident(table, quote)
    if partitioning is not None and check_column:
        plain = _load(spark, reader_options(base, dbtable))
        if not partitionable(partitioning, plain.schema):
            return plain
    if partitioning is not None and partitioning.balance != "stride":
        # Tiles come from the base table, like the stride bounds below.  A
        # source that cannot compute them fails the extract: equal strides
        # have to be asked for.
        hashed = partitioning.balance == "hash"
        preds = hash_predicates(partitioning, quote) if hashed else quantile_predicates(spark, base, quote_ident(table, quote), partitioning, quote)
        if len(preds) > 1:
            return _load_parts(spark, base, dbtable, preds, partitioning.fetch_size)
        partitioning = None  # an empty table or a single key value
    bounds = None
    if partitioning is not None and (partitioning.lower is None or partitioning.upper is None):
        # Bounds come from the base table: the derived subquery would run the
        # source function on every row just to find min and max.
        bounds = _key_bounds(spark, base, quote_ident(table, quote), partitioning.column, quote)
    return _load(spark, reader_options(base, dbtable, partitioning, bounds))
