"""Named source registry (S3) and table reads.

A source is a name bound to how its tables are read: ``parquet`` (a folder
of ``<table>.parquet`` datasets), ``table`` (a catalog database, with an
optional name prefix), ``records`` (landed CRM JSON, one folder per object)
or ``jdbc`` (a connection).  Connection options are supplied at run time by
the caller; nothing secret lives in code.
"""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..context import local_frame
from ..functions.windows import Marks
from ..operators.incremental import read_marks
from . import jdbc
from .catalog import jdbc_catalog_frame, spark_catalog_frame


@dataclass(frozen=True)
class SourceConfig:
    name: str
    format: str  # "parquet" | "table" | "records" | "jdbc"
    root: str = ""  # data folder, or catalog database for "table"
    path_template: str = "{root}/{table}.parquet"
    prefix: str = ""  # "table": catalog name = prefix + table
    options: Mapping[str, str] = field(default_factory=dict)  # jdbc url, driver, user, ...
    partitioning: Mapping[str, jdbc.JdbcPartitioning] = field(default_factory=dict)
    # jdbc: the plan of tables without their own entry in ``partitioning``,
    # used where the table has its key column (e.g. ``id``); others are read
    # whole.  Without it such tables are read by their primary key.
    default_partitioning: jdbc.JdbcPartitioning | None = None
    # jdbc: ranges at most of a table that is read by its primary key (which
    # the source's catalog tells); 0 or 1: by one task.
    auto_partitions: int = 16
    quote: str = "`"
    # Extracts reading this source at once (None: no cap).  With JDBC a read
    # opens one connection per partition, so this times ``num_partitions``
    # bounds the connections an operational database sees.
    max_parallel_reads: int | None = None


class SourceRegistry:
    def __init__(self, configs: Iterable[SourceConfig] = ()):
        self._configs: dict[str, SourceConfig] = {}
        self._gates: dict[str, threading.BoundedSemaphore] = {}
        self._keys: dict[tuple[str, str, str], tuple[str, ...]] = {}
        for c in configs:
            self.add(c)

    def add(self, config: SourceConfig) -> "SourceRegistry":
        self._configs[config.name] = config
        if config.max_parallel_reads:
            self._gates[config.name] = threading.BoundedSemaphore(config.max_parallel_reads)
        return self

    def gate(self, source: str):
        """Held by an extract while it reads ``source``: a semaphore of
        ``max_parallel_reads`` slots, or nothing when uncapped."""
        return self._gates.get(source) or contextlib.nullcontext()

    def get(self, name: str) -> SourceConfig:
        if name not in self._configs:
            raise KeyError(f"unknown source {name!r}; known: {sorted(self._configs)}")
        return self._configs[name]

    def names(self) -> list[str]:
        return sorted(self._configs)

    def path(self, source: str, table: str) -> str:
        cfg = self.get(source)
        return cfg.path_template.format(root=cfg.root.rstrip("/"), table=table)

    def read(
        self,
        spark: SparkSession,
        source: str,
        table: str,
        derived: Mapping[str, str] | None = None,
        partitioned: bool = True,
        schema: str | None = None,
    ) -> DataFrame:
        """A lazy scan of ``table``; ``derived`` (JDBC only) evaluates
        source-side expressions inside the source query.  ``partitioned=False``
        reads a JDBC table through one connection: one snapshot, as a single
        ``SELECT`` sees, where parallel range reads each see their own.  A
        JDBC table without a plan is read by its primary key, looked up in
        ``schema``."""
        cfg = self.get(source)
        if cfg.format == "jdbc":
            own = cfg.partitioning.get(table) if partitioned else None
            plan = own or (cfg.default_partitioning if partitioned else None)
            if partitioned and plan is None and schema and cfg.auto_partitions > 1:
                # Asked once for each table; a lookup that failed is asked again.
                key = self._keys.get((source, schema, table)) or self.unique_key(spark, source, schema, table)
                if key:
                    self._keys[source, schema, table] = key
                    return jdbc.read_by_key(spark, cfg.options, table, key, cfg.auto_partitions, derived, cfg.quote)
            return jdbc.read_table(spark, cfg.options, table, plan, derived, cfg.quote,
                                   check_column=own is None and plan is not None)
        if derived:
            raise ValueError("source-side derived columns need a jdbc source")
        if cfg.format == "parquet":
            return spark.read.parquet(self.path(source, table))
        if cfg.format == "table":
            name = cfg.prefix + table
            return spark.table(f"{cfg.root}.{name}" if cfg.root else name)
        raise ValueError(f"unsupported source format {cfg.format!r}")

    def folds_case(self, spark: SparkSession, source: str) -> bool:
        """Whether table names of ``source`` match regardless of case: true
        for Spark catalog tables (the session catalog and a Hive metastore
        keep names in lower case) unless ``spark.sql.caseSensitive`` is on.
        JDBC catalogs and folders report names as they are spelled."""
        if self.get(source).format != "table":
            return False
        return spark.conf.get("spark.sql.caseSensitive", "false").lower() != "true"

    def catalog(self, spark: SparkSession, source: str, schema: str | None = None,
                names: list[str] | None = None, fold_case: bool = False) -> DataFrame:
        """``(table_schema, table_name)`` of the source's catalog;
        ``fold_case`` matches schema and names regardless of case (S5)."""
        cfg = self.get(source)
        if cfg.format == "jdbc":
            return jdbc_catalog_frame(spark, cfg.options, schema or "", names, fold_case)
        if cfg.format == "table":
            cat = spark_catalog_frame(spark, cfg.root or None)
            if cfg.prefix:
                plen = len(cfg.prefix)
                cat = cat.where(F.lower("table_name").startswith(cfg.prefix.lower())).select(
                    "table_schema", F.expr(f"substring(table_name, {plen + 1})").alias("table_name"))
            return cat
        return self._path_catalog(spark, source, names or [])

    def _path_catalog(self, spark: SparkSession, source: str, names: list[str]) -> DataFrame:
        """A folder of datasets has no catalog; a name exists when its path
        does (the ``text`` source lists files without reading them).
        Checked only for allow-listed names (bounded), several at once: on an
        object store each check is a remote listing."""
        cfg = self.get(source)

        def exists(n: str) -> bool:
            try:
                spark.read.format("text").load(self.path(source, n))
            except AnalysisException:
                return False
            return True

        with ThreadPoolExecutor(min(16, max(1, len(names)))) as pool:
            flags = list(pool.map(exists, names))
        found = [(cfg.root, n) for n, ok in zip(names, flags) if ok]
        return local_frame(spark, found, "table_schema string, table_name string")

    def unique_key(self, spark: SparkSession, source: str, schema: str, table: str) -> tuple[str, ...] | None:
        """The columns of ``table``'s primary key where the source enforces
        one (JDBC), else ``None``.  One small catalog query; the result has a
        row per key column.  A catalog that cannot be asked (permissions, a
        dialect without these views) also gives ``None``: the key only ever
        saves a shuffle or splits a read, it never decides rows."""
        cfg = self.get(source)
        if cfg.format != "jdbc":
            return None
        try:
            found = jdbc.query_one_row(spark, cfg.options, jdbc.primary_key_query(schema, table))
            rows = found.toDF("column_name", "ordinal_position").collect()  # sources may fold aliases
        except Exception:
            return None
        return tuple(r["column_name"] for r in sorted(rows, key=lambda r: r["ordinal_position"])) or None

    def marks(self, spark: SparkSession, source: str, table: str,
              created: str = "created_at", updated: str = "updated_at", zone: str | None = None) -> Marks:
        """High-water marks of a target table, as wall clock in ``zone``.  On JDBC the source
        computes the maxima and returns one row."""
        cfg = self.get(source)
        if cfg.format == "jdbc":
            sql = jdbc.marks_query(jdbc.quote_ident(table, cfg.quote), created, updated, cfg.quote)
            df = jdbc.query_one_row(spark, cfg.options, sql)
            return read_marks(df.toDF(created, updated), created, updated, zone)
        return read_marks(self.read(spark, source, table), created, updated, zone)
