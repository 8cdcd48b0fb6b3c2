"""License scans: an exact set-similarity join of text blocks with license
templates, in DataFrame operations only.

Texts are cut into words once, and the words that templates or phrases hold are
stored with their places; all that follows reads those.  A text's words form
overlapping blocks (every run of up to ``BLOCK - STEP`` words lies whole in a
block).  A block meets a template when
it holds at least ``CONTAINMENT`` of the template's distinct words.  Words of
no template can't be shared, so blocks keep template words alone, in the order
of their corpus-wide document frequency, rarest first.  A block can only meet
a template when the two share a word among the rarest of each (prefix
filter), so blocks are joined to templates on those words; length and
positional filters drop candidates that can't reach the threshold, and the
rest are compared on their full sets.  Nothing is missed.

Exact phrases are found as well, by word position.  Templates and phrases are
parameters: their words bound what the driver and the joins hold beside the
documents.  A null or empty text has no words, no block, null positions, no
labels and score 0.  Rows are kept apart by a row number, so repeated rows
and ids each get their own result.  A very long text is cut into blocks like
others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import local_frame
from .common import LOWER, UPPER, col, lower_ascii, stored, table, text_of

#: Words of the raw text; A-Z count as a-z.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Phrases whose places are counted, with their labels (fixed values).
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Wording of well-known license notices, lower-cased, with their labels.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0 you may not use this file except in compliance with the license", "apache-2"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
)
CONTAINMENT, BLOCK, STEP = 0.8, 64, 32


def hits_of(words: Column, vocabulary: list[str], step: int) -> Column:
    """The words that are in the vocabulary, with their places, in one array
    for each run of ``step`` words.  A-Z are lowered for candidates alone:
    ``lower`` maps at least as many words into the (ASCII) vocabulary."""
    def known(i: Column) -> Column:
        return F.lower(F.get(words, i)).isin(vocabulary) & lower_ascii(F.get(words, i)).isin(vocabulary)

    def run(c: Column) -> Column:
        ids = F.sequence(c * step, F.least(c * step + step, F.size(words)) - 1)
        return F.transform(F.filter(ids, known), lambda i: F.struct(i.alias("at"), lower_ascii(F.get(words, i)).alias("word")))

    some = F.transform(F.sequence(F.lit(0), F.ceil(F.size(words) / F.lit(step)).cast("int") - 1), run)
    return F.when(F.size(words) > 0, some).otherwise(F.array().cast("array<array<struct<at:int,word:string>>>"))


def places(hits: Column, phrase: str) -> Column:
    """Starts, from 0, of the places where the phrase's words stand in a row;
    ``hits`` hold all of the phrase's words, by place."""
    parts = phrase.split()
    last = len(parts) - 1

    def here(i: Column) -> Column:
        out = F.get(hits, i)["word"] == parts[0]
        for k, part in enumerate(parts[1:], 1):
            out = out & (F.get(hits, i + k)["word"] == part)
        return out & (F.get(hits, i + last)["at"] - F.get(hits, i)["at"] == last)

    starts = F.transform(F.filter(F.sequence(F.lit(0), F.size(hits) - 1 - last), here), lambda i: F.get(hits, i)["at"])
    return F.when(F.size(hits) > last, starts).otherwise(F.array().cast("array<int>"))


def _needed(size: int, containment: float) -> int:
    return math.ceil(containment * size - 1e-9)


def vocabulary_order(rows: DataFrame, templates) -> list[str]:
    """The templates' words by document frequency, rarest first.  The driver
    gets one row per word."""
    vocabulary = sorted({w for text, _ in templates for w in text.split()})
    used = F.array_distinct(F.flatten(F.transform("runs", lambda r: r["word"])))
    counts = dict(rows.select(F.explode(used).alias("word")).groupBy("word").count().collect())
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def scan(spark: SparkSession, docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, containment: float = CONTAINMENT,
         block: int = BLOCK, step: int = STEP) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels
    (arrays) and score for every row of ``docs``.  ``block`` is a multiple of
    ``step``."""
    if block % step:
        raise ValueError("block must be a multiple of step")
    known = sorted({w for text, _ in [*phrases, *templates] for w in text.split()})
    rows = docs.select(col(docs, "doc_id").alias("doc_id"), F.regexp_extract_all(text_of(docs), F.lit(WORDS), 0).alias("words"))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").alias("n"), hits_of(F.col("words"), known, step).alias("runs"))
    rows = stored(spark, rows, "license_hits")  # texts are read and cut into words once

    order = vocabulary_order(rows, templates)
    rank = {w: i for i, w in enumerate(order)}
    sets = [(label, sorted({rank[w] for w in text.split()})) for text, label in templates]
    prefixes = [(label, s, _needed(len(s), containment)) for label, s in sets]
    least = min(need for _, _, need in prefixes)
    index = local_frame(spark, [(s[i], i, len(s), need, label, s) for label, s, need in prefixes for i in range(len(s) - need + 1)],
                        "word_rank int, at_t int, size_t int, need int, label string, ranks_t array<int>")
    rare = F.array(*[F.lit(order[r]) for r in sorted({s[i] for _, s, need in prefixes for i in range(len(s) - need + 1)})])

    n_blocks = F.greatest(F.lit(1), F.ceil((F.col("n") - block) / F.lit(step)).cast("int") + 1)
    in_block = lambda b: F.array_distinct(F.filter(F.flatten(F.slice("words", b + 1, block // step)), lambda w: w.isin(order)))
    blocks = F.filter(F.transform(F.sequence(F.lit(0), n_blocks - 1), in_block), lambda b: F.arrays_overlap(b, rare) & (F.size(b) >= least))
    place = F.array_sort(F.transform("block", lambda w: (F.array_position(F.lit(order), w) - 1).cast("int")))
    found = rows.select("row", "n", F.transform("runs", lambda r: r["word"]).alias("words")).where(F.arrays_overlap(F.flatten("words"), rare))
    found = found.select("row", F.explode(blocks).alias("block")).select("row", place.alias("ranks"))
    found = found.select("row", "ranks", F.posexplode(F.slice("ranks", 1, F.size("ranks") - least + 1)).alias("at_b", "word_rank"))
    could = F.least(F.size("ranks") - F.col("at_b"), F.col("size_t") - F.col("at_t")) >= F.col("need")
    pairs = found.join(index, "word_rank").where((F.size("ranks") >= F.col("need")) & could)
    pairs = pairs.withColumn("shared", F.size(F.array_intersect("ranks", "ranks_t"))).where("shared >= need")
    found = pairs.groupBy("row").agg(F.collect_set("label").alias("more"), F.max(F.col("shared") / F.col("size_t")).alias("best"))

    rows = rows.select("row", "doc_id", F.col("n").cast("long").alias("n_words"), F.flatten("runs").alias("hits"))
    rows = rows.select("row", "doc_id", "n_words", *[places(F.col("hits"), phrase).alias(f"p{k}") for k, (phrase, _) in enumerate(phrases)])
    at = F.flatten(F.array(*[f"p{k}" for k in range(len(phrases))]))
    base = F.filter(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(phrases)]), lambda x: x.isNotNull())
    rows = rows.select("row", "doc_id", "n_words", at.alias("at"), F.array_sort(F.array_distinct(base)).alias("base_labels"))
    n_base = F.size("at").cast("long")
    none = F.array().cast("array<string>")
    return rows.join(found, "row", "left").select(
        "doc_id", "n_words", n_base.alias("n_base"), F.array_min("at").cast("long").alias("first_word"), F.array_max("at").cast("long").alias("last_word"),
        "base_labels", F.array_sort(F.array_union("base_labels", F.coalesce("more", none))).alias("labels"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(spark, table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


LOWER_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _op7_sql() -> str:
    lists = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    found = ", ".join(f"list_filter(range(0, greatest(len(w) - {len(p.split()) - 1}, 0)), lambda i: w[i + 1:i + {len(p.split())}] = {lists(p.split())}) AS p{k}" for k, (p, _) in enumerate(PHRASES))
    base = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, (_, label) in enumerate(PHRASES))
    at = " || ".join(f"p{k}" for k in range(len(PHRASES)))
    sets = ", ".join(f"({lists(sorted(set(t.split())))}, '{label}', {_needed(len(set(t.split())), CONTAINMENT)})" for t, label in TEMPLATES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{LOWER_WORDS}') AS w FROM documents),
f AS (SELECT r, doc_id, w, {found} FROM d),
g AS (SELECT r, doc_id, w, {at} AS hits, list_filter([{base}], lambda x: x IS NOT NULL) AS base FROM f),
t(words, label, need) AS (VALUES {sets}),
b AS (SELECT r, list_distinct(w[s * {STEP} + 1:s * {STEP} + {BLOCK}]) AS block FROM
      (SELECT r, w, unnest(range(0, greatest(1, ceil((len(w) - {BLOCK}) / {STEP}::DOUBLE)::INT + 1))) AS s FROM d)),
m AS (SELECT r, label, len(list_intersect(block, words)) / len(words)::DOUBLE AS part FROM b, t WHERE len(list_intersect(block, words)) >= need),
a AS (SELECT r, list(DISTINCT label) AS more, max(part) AS best FROM m GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, len(hits)::BIGINT AS n_base, list_min(hits)::BIGINT AS first_word, list_max(hits)::BIGINT AS last_word,
  array_to_string(list_sort(base), ',') AS base_labels, array_to_string(list_sort(list_distinct(base || coalesce(more, []))), ',') AS labels,
  CASE WHEN len(hits) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM g LEFT JOIN a USING (r)
"""


OP7_SQL = _op7_sql()
