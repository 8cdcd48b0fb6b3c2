"""Catalog lookup with an allow-list (S4) and case folding.

The manifest names a schema and the tables wanted from it; only those that
exist in the source catalog are extracted, and missing ones are skipped.
The catalog is a frame ``(table_schema, table_name)``; the allow-list is
bounded by the manifest, so it is applied as an ``IN`` filter (which a JDBC
catalog query evaluates at the source).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import local_frame
from . import jdbc

CATALOG_SCHEMA = "table_schema string, table_name string"


def spark_catalog_frame(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views of the Spark session catalog (``SHOW TABLES``).
    Temporary views carry an empty schema name."""
    shown = spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")
    return shown.select(F.col("namespace").alias("table_schema"), F.col("tableName").alias("table_name"))


def jdbc_catalog_frame(spark: SparkSession, options: Mapping[str, str], schema: str,
                       names: Sequence[str] | None = None, fold_case: bool = False) -> DataFrame:
    """``information_schema.tables`` of a JDBC source, filtered at the source."""
    return jdbc.query_one_row(spark, options, jdbc.catalog_query(schema, list(names) if names else None, fold_case))


def allowlist_frame(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """The manifest's names as a one-column frame (bounded by the manifest)."""
    return local_frame(spark, [(n,) for n in names], "table_name string")


def allowlisted(
    spark: SparkSession,
    catalog: DataFrame,
    names: Sequence[str],
    schema: str | None = None,
    fold_case: bool = False,
) -> DataFrame:
    """catalog names that are in ``names`` (and in ``schema`` if given).

    With ``fold_case`` (S5/X7) the catalog's names are lowered first, as the
    warehouse spells them upper case while sources and paths use lower.
    """
    cat = catalog
    if schema is not None:
        cond = F.lower(cat["table_schema"]) == schema.lower() if fold_case else cat["table_schema"] == schema
        cat = cat.where(cond)
    name_col = F.lower(cat["table_name"]) if fold_case else cat["table_name"]
    wanted = list(dict.fromkeys(n.lower() for n in names)) if fold_case else list(dict.fromkeys(names))
    return cat.select(name_col.alias("table_name")).where(F.col("table_name").isin(wanted))


def existing_tables(
    spark: SparkSession,
    catalog: DataFrame,
    names: Sequence[str],
    schema: str | None = None,
    fold_case: bool = False,
) -> list[str]:
    """Allow-listed names present in the catalog, in manifest order.  The
    collect is bounded by the allow-list's length."""
    present = {r["table_name"] for r in allowlisted(spark, catalog, names, schema, fold_case).collect()}
    return [n for n in names if (n.lower() if fold_case else n) in present]
