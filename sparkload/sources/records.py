"""CRM record sets (S6) landed as JSON.

The reference pulls records through a paged REST client.  Here the records
are landed files that Spark reads in parallel, in one pass, with declared
types (no inference).  Layouts:

* ``lines``: one record object per line (splittable, the large-scale form);
* ``pages``: API responses, ``{"records": [...], ...}``, on one line or many.
  A page is read as text cut at the records' envelope keys, so a large page
  is split between tasks like any text file, at record boundaries.  Records have
  their envelope first and none inside, as flat field lists return them;
  any other page fails the read (pages without envelopes are parsed whole);
* ``whole_pages``: API responses of any shape, each file parsed whole by one
  task (``multiLine``).

Each record carries an ``attributes`` envelope (type and url); only the
object's field list (P3) is selected, so the envelope is left out (P5).

A record is parsed once: into a map of texts when all fields are text, else
into a map of variants, from which each field is taken by its type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = "attributes"
ENVELOPE_TYPE = T.StructType([T.StructField("type", T.StringType()), T.StructField("url", T.StringType())])


def _as_struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def record_schema(fields: T.StructType | str) -> T.StructType:
    """Schema of one landed record: the envelope plus the object's fields."""
    struct = _as_struct(fields)
    names = {f.name.lower() for f in struct.fields}
    extra = [] if ENVELOPE in names else [T.StructField(ENVELOPE, ENVELOPE_TYPE)]
    return T.StructType(extra + list(struct.fields))


def string_fields(names: Sequence[str]) -> T.StructType:
    """A schema reading every listed field as text (values as the API sent
    them) when no typed schema is known."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_PAGE = T.StructType([T.StructField("records", T.ArrayType(T.StringType()))])
_ENVELOPE_KEY = f'"{ENVELOPE}"'


def _page_records(spark: SparkSession, path: str) -> DataFrame:
    """``value``: each record's JSON text, what follows it on the page
    included (a parser stops at the record's end).

    The text between two envelope keys, which JSON cannot hold inside a string,
    starts inside a record and ends with the next one's brace, or with the
    page's end.  A piece that ends otherwise shows a record whose envelope is
    not first; one that breaks off inside a record (an envelope within) does not
    parse.  What stands before the first envelope is the page's head, or, on a
    page without envelopes, all of it."""
    pieces = spark.read.option("lineSep", _ENVELOPE_KEY).text(path)
    body = F.trim(F.regexp_replace(F.substring(pieces["value"], 1, 64), r"\s+", " "))
    last = F.right(F.rtrim(pieces["value"], F.lit(" \t\r\n")), F.lit(1))
    inside = body.startswith(":")
    no_text = F.array().cast("array<string>")
    whole = F.coalesce(F.from_json(pieces["value"], _PAGE, {"mode": "FAILFAST"})["records"], no_text)
    found = (F.when(~last.isin("{", "}", "]", ""), F.array(F.raise_error(F.lit("a record's envelope is not its first key")).cast("string")))
             .when(inside, F.array(F.concat(F.lit("{" + _ENVELOPE_KEY), pieces["value"])))
             .when(last.isin("{", ""), no_text)
             .otherwise(whole))
    return pieces.select(F.explode(found).alias("value"))


def _values(spark: SparkSession, path: str, layout: str, typed: bool) -> DataFrame:
    """``record``: each landed record as a map of lower-cased key to value: as
    text (strings as they are, anything else as its JSON text) or, if ``typed``,
    as variants.  Keys that differ only in case fail, as does a record that
    does not parse."""
    if layout == "lines":
        rows = spark.read.text(path)
        rows = rows.where(F.trim(rows["value"]) != "")
    elif layout == "pages":
        rows = _page_records(spark, path)
    elif layout == "whole_pages":
        rows = (spark.read.schema(_PAGE).option("multiLine", "true").option("mode", "FAILFAST").json(path)
                .select(F.explode("records").alias("value")))
    else:
        raise ValueError(f"unknown records layout {layout!r}")
    kind = T.MapType(T.StringType(), T.VariantType() if typed else T.StringType())
    none = F.raise_error(F.lit("a landed line holds no record"))
    record = F.coalesce(F.from_json(rows["value"], kind, {"mode": "FAILFAST"}), none)
    return rows.select(F.transform_keys(record, lambda k, _: F.lower(k)).alias("record"))


# Types a JSON number, text or flag may be read as, by the variant's own type.
_NUMBERS = (T.DecimalType, T.FloatType, T.DoubleType)
_MOMENTS = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _value(key: str, dtype: T.DataType, typed: bool) -> Column:
    """One field of a record.  By the JSON reader's own rules a quoted number
    is a text, a fraction no whole number, and a moment a text."""
    v = F.try_element_at("record", F.lit(key))
    if not typed:
        return v
    kind = F.schema_of_variant(v)
    if isinstance(dtype, T.StringType):
        return F.when(kind == "STRING", F.variant_get(v, "$", "string")).when(~F.is_variant_null(v), F.to_json(v))
    if isinstance(dtype, T.IntegralType):
        fits = kind == "BIGINT"
    elif isinstance(dtype, _NUMBERS):
        fits = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    elif isinstance(dtype, T.BooleanType):
        fits = kind == "BOOLEAN"
    elif isinstance(dtype, _MOMENTS):
        fits = kind == "STRING"
    else:  # nested values, by the JSON reader
        one = F.concat(F.lit('{"v":'), F.to_json(v), F.lit("}"))
        return F.from_json(one, T.StructType([T.StructField("v", dtype)]), {"mode": "FAILFAST"})["v"]
    bad = F.raise_error(F.concat(F.lit(f"field {key} is no {dtype.simpleString()} but "), kind)).cast(dtype)
    return F.when(v.isNotNull() & ~F.is_variant_null(v), F.when(fits, F.variant_get(v, "$", dtype.simpleString())).otherwise(bad))


def read_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fields: Sequence[str] | None = None,
    layout: str = "lines",
    seen: Observation | None = None,
) -> DataFrame:
    """S6 + P3 + P5: landed records → the object's field list, no envelope.

    Field names are matched regardless of case, as the reference's frame of
    API records is selected: a query may spell ``NAME`` or ``ContactID``
    while the API returns ``Name`` and ``ContactId``.  Every record is matched
    on its own keys, in one pass, so a field that some records leave out
    (a null the writer did not write) is null there and nowhere else.
    Types are those of ``schema`` (text for fields it does not declare);
    columns are named as in ``schema``, else as in ``fields``.  A malformed
    record or value fails the read rather than turn into nulls.  Numbers
    read as text are in the shortest form (``1.5`` for ``1.50``).  ``seen``
    observes for each column whether any record has its key.
    """
    struct = _as_struct(schema)
    declared = {f.name.lower(): f for f in struct.fields}
    wanted = [f for f in (fields if fields is not None else struct.fieldNames()) if f.lower() != ENVELOPE]
    out = [(n.lower(), declared[n.lower()].name if n.lower() in declared else n) for n in wanted]
    types = {key: declared[key].dataType if key in declared else T.StringType() for key, _ in out}
    typed = any(not isinstance(t, T.StringType) for t in types.values())
    rows = _values(spark, path, layout, typed)
    if seen is not None:
        rows = rows.observe(seen, *[F.max(F.map_contains_key("record", key)).alias(name) for key, name in out])
    return rows.select(*[_value(key, types[key], typed).alias(name) for key, name in out])


def to_records(df: DataFrame, object_type: str, url_prefix: str, id_column: str) -> DataFrame:
    """Wrap rows of ``df`` as records with an ``attributes`` envelope, the
    shape the CRM returns (used to land a table as records)."""
    env = F.struct(F.lit(object_type).alias("type"),
                   F.concat(F.lit(url_prefix), df[id_column].cast("string")).alias("url")).alias(ENVELOPE)
    return df.select(env, *[df[c] for c in df.columns])
