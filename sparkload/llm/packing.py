"""Best-fit packing of token sequences: best-two-fit over a histogram of lengths.

A sequence is filled greedily: the longest unpacked document, then again and
again the longest one that fits.  While a gap stays, the sequence's smallest
document is replaced by the two unpacked ones that fill the gap and its place
most tightly (if that is tighter than before), and filling goes on.

What is packed depends on lengths alone, so sequences are planned from the
histogram of lengths, at most ``limit`` rows whatever the corpus: as long as
no length that a sequence takes runs out, the next one comes out the same, so
the plan holds patterns and how often each is used (``plan``; equal to packing
one sequence after another).  The driver holds the histogram and the plan;
documents stay in Spark.

Every piece has a number among the pieces of its length: the place within its
task (given as it is encoded, then stored) and the count of the tasks before,
summed by length.  No task sees all pieces of a length.  A pattern takes pieces
of a length by these numbers, so a binary search over the plan, at most some ten
thousand entries, gives a piece its sequence and offset.

A document is its text's ids and the end id; only longer ones than ``limit``
are cut, and the last piece is packed with the others.  Texts are
cut where this tokenizer cuts them too (``cut_units``), and each different unit
is encoded by the tokenizers library once per worker and remembered in bounded
space; the ids of units follow one another.  Null and empty texts are the end id
alone; repeated rows are packed as often as they occur, null ids like others;
very long texts are cut like all; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Memo, col, map_partitions, stored, table, text_of, worker_state
from .token_counts import load

LIMIT = 2048
END_ID = 0
#: Bytes of text that are cut into words at a time.
SLICE = 8 << 20
#: Units that go to the library as one text.
TOGETHER = 500
#: The pattern and normal form that ``cut_units`` follows.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPACE, _LETTER, _DIGIT, _MARK, _WIDE = range(5)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[list(b" \t\n\v\f\r")] = _SPACE
_CLASS[list(b"0123456789")] = _DIGIT
_CLASS[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = _LETTER
_CLASS[128:] = _WIDE
_CLASS[list(b"'<")] = _WIDE  # of contractions and special strings


def cut_units(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes without their ASCII white space (letters A-Z as a-z in words
    that are cut further), where units start in them, and which of ``data``'s
    places those are.  A unit is a run of letters, a run of marks or a digit;
    words with other characters than ASCII and the letters of Latin-1 (the pairs
    C3 80 to C3 BF but for two signs), or with an apostrophe or ``<``, are units
    as a whole."""
    kind = _CLASS[data]
    wide = np.flatnonzero(data == 0xC3)
    wide = wide[wide + 1 < len(data)]
    second = data[wide + 1]
    wide = wide[(second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)]
    kind[wide] = kind[wide + 1] = _LETTER
    inside = kind != _SPACE
    first = inside.copy()  # of a word
    first[1:] &= ~inside[:-1]
    words = np.flatnonzero(first)
    whole = np.zeros(len(words), bool)
    whole[np.searchsorted(words, np.flatnonzero(kind == _WIDE), "right") - 1] = True
    cut = first.copy()
    cut[1:] |= inside[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
    kept = data[inside]
    if whole.any():
        in_whole = np.repeat(whole, np.diff(np.append(np.cumsum(inside)[words] - 1, len(kept))))
        starts = cut[inside]
        starts[in_whole] = first[inside][in_whole]
        lower = ~in_whole
    else:
        starts, lower = cut[inside], True
    kept = np.where((kept >= 65) & (kept <= 90) & lower, kept + 32, kept).astype(np.uint8)
    return kept, np.flatnonzero(starts), np.flatnonzero(inside)[starts]


def plan(lengths: np.ndarray, limit: int) -> list[tuple[int, dict[int, int]]]:
    """Patterns as (sequences, {length: documents in each}), from the number
    of documents of each length (index 0 to ``limit``; 0 has none)."""
    left, places, out = lengths.astype(np.int64).copy(), np.arange(limit + 1), []
    while left.any():
        free = left.copy()  # without what the sequence in hand takes
        shown = np.maximum.accumulate(np.where(left > 0, places, 0))
        has: dict[int, int] = {}
        peak: dict[int, int] = {}

        def take(length: int, n: int) -> None:
            has[length] = has.get(length, 0) + n
            free[length] -= n
            peak[length] = max(peak.get(length, 0), has[length])

        gap = limit
        while True:
            x = int(shown[gap])
            while x:
                if n := min(int(free[x]), gap // x):
                    take(x, n)
                    gap -= n * x
                x = int(shown[min(gap, x - 1)])
            if not gap or sum(has.values()) < 2:
                break
            least = min(k for k, n in has.items() if n)
            room = gap + least
            best = np.maximum.accumulate(np.where(free[:room + 1] > 0, places[:room + 1], 0))
            one = np.flatnonzero(free[:room + 1] > 0)
            two = best[room - one]
            lone = (two == one) & (free[one] == 1)
            two[lone] = best[np.maximum(one[lone] - 1, 0)]
            both = np.where((two > 0) & (two <= one), one + two, 0)
            if not len(both) or both.max() <= least:
                break
            at = len(both) - 1 - int(both[::-1].argmax())
            take(least, -1)
            take(int(one[at]), 1)
            take(int(two[at]), 1)
            gap = room - int(both[at])
        pattern = {k: n for k, n in has.items() if n}
        times = min(int(left[k] - peak[k]) // n + 1 for k, n in pattern.items())
        for k, n in pattern.items():
            left[k] -= n * times
        out.append((times, pattern))
    return out


class Slots:
    """A plan as arrays to look pieces up in."""

    def __init__(self, patterns: list[tuple[int, dict[int, int]]]):
        rows, first, taken = [], 0, {}
        for times, pattern in patterns:
            at = 0
            for length, n in pattern.items():
                rows.append((length, taken.get(length, 0), n, first, at))
                taken[length] = taken.get(length, 0) + n * times
                at += n * length
            first += times
        self.sequences = first
        self.length, self.lo, self.each, self.first, self.at = np.array(sorted(rows), np.int64).reshape(-1, 5).T
        self.starts = np.searchsorted(self.length, np.arange(LIMIT if not rows else self.length.max() + 2))

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the ``number``-th pieces of a ``length``."""
        order = np.lexsort((number, length))
        slot = np.empty(len(length), np.int64)
        for some in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
            a, b = self.starts[length[some[0]]], self.starts[length[some[0]] + 1]
            slot[some] = a + np.searchsorted(self.lo[a:b], number[some], "right") - 1
        turn, place = np.divmod(number - self.lo[slot], self.each[slot])
        return self.first[slot] + turn, self.at[slot] + place * length


class UnitIds:
    """Ids of a text's units by the tokenizers library, as bytes of 32-bit
    numbers."""

    def __init__(self, path: str):
        tokenizer = load(path)
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        steps = data["normalizer"]["normalizers"], data["pre_tokenizer"]["pretokenizers"][0]
        if [x["type"] for x in steps[0]] != NORMALIZERS or steps[1]["pattern"] != {"Regex": PATTERN}:
            raise ValueError("units are cut by another pattern than this tokenizer's")
        vocabulary, end = tokenizer.get_vocab(), data["model"]["end_of_word_suffix"]
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(end)]] = True
        self.encode = lambda texts: [np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        self.memo = Memo(lambda unit: self.many([unit])[0])

    def many(self, units: list[str]) -> list[bytes]:
        """Units go to the library as texts of many.  Each has one id that ends
        a word; if the numbers differ (whole words may have several or, special
        strings, none), they go alone."""
        out: list[bytes] = []
        groups = [units[i:i + TOGETHER] for i in range(0, len(units), TOGETHER)]
        sure = [[u for u in g if "'" not in u and "<" not in u and u.encode("latin-1", "replace").decode("latin-1") == u] for g in groups]
        for group, some, ids in zip(groups, sure, self.encode([" ".join(g) for g in sure])):
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some):
                data, cuts = ids.tobytes(), [0, *(ends * 4).tolist()]
                found = {u: data[a:b] for u, a, b in zip(some, cuts, cuts[1:])}
            else:
                found = {}
            rest = [u for u in group if u not in found]
            found.update(zip(rest, (x.tobytes() for x in self.encode(rest))))
            out += [found[u] for u in group]
        return out

    def texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, its units' one after another."""
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        cuts = np.searchsorted(sizes, np.arange(1, (int(sizes[-1]) if len(sizes) else 0) // SLICE + 1) * SLICE, "right")
        for a, b in zip([0, *cuts], [*cuts, len(texts)]):
            if b > a:
                yield from self.some(texts.slice(a, b - a).to_pylist())

    def some(self, texts: list[str]) -> list[np.ndarray]:
        raw = [t.encode() for t in texts]
        kept, starts, places = cut_units(np.frombuffer(b"\n".join(raw), np.uint8))
        ends = np.cumsum([len(r) + 1 for r in raw])
        offsets = pa.array(np.append(starts, len(kept)), pa.int64())
        units = pa.LargeStringArray.from_buffers(len(starts), offsets.buffers()[1], pa.py_buffer(kept))
        return self.memo.joined_array(units, np.searchsorted(ends, places, "right"), len(raw), self.many, "<u4")


def encode_pieces(docs: DataFrame, path: str, limit: int = LIMIT, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32 (and ids),
    and part and seq, which number the pieces of its length."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, part, seen = worker_state(("units", path), lambda: UnitIds(path)), TaskContext.get().partitionId(), np.zeros(limit + 1, np.int64)
        end = np.array([end_id], "<u4")
        for batch in batches:
            out, pieces = [], []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), units.texts(batch.column("text"))):
                ids = np.concatenate((ids, end))
                for k, start in enumerate(range(0, len(ids), limit)):
                    some = ids[start:start + limit]
                    out.append((doc_id, k, start, len(some), zlib.crc32(some.tobytes()), part, int(seen[len(some)])))
                    seen[len(some)] += 1
                    if with_ids:
                        pieces.append(some.astype(np.int32))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            if with_ids:
                columns.append(pa.array(pieces, pa.list_(pa.int32())))
            yield pa.record_batch(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "part", "seq"] + ["ids"] * with_ids)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, seq long" + ", ids array<int>" * with_ids
    texts = docs.select(col(docs, "doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return map_partitions(texts, rows, schema)


def pack(spark: SparkSession, pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Stores the pieces (their numbers hold for one run of the tasks) and
    adds sequence_id and offset."""
    pieces = stored(spark, pieces, "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    counts = stored(spark, counts.withColumn("before", F.coalesce(before, F.lit(0))), "piece_counts")
    lengths = np.zeros(limit + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # a row for each length
        lengths[length] = n
    slots = Slots(plan(lengths, limit))
    numbered = pieces.join(counts.drop("n").hint("merge"), ["part", "length"])  # grows with the tasks: no broadcast
    numbered = numbered.select(*[c for c in pieces.columns if c not in ("part", "seq")], (F.col("before") + F.col("seq")).alias("number"))
    kept = [c for c in numbered.columns if c != "number"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = slots(batch.column("length").to_numpy(), batch.column("number").to_numpy())
            yield pa.record_batch([batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.select(kept).schema)
    return map_partitions(numbered, place, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences (of pieces with ids)."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most ``limit`` ids
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(inside, lambda p: p["ids"])).alias("ids"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return pack(spark, encode_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))
