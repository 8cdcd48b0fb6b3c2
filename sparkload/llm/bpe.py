"""Byte-level BPE: encoding by a priority queue of merge ranks, and decoding.

A text is cut at the vocabulary's special strings, each piece by the
vocabulary's pattern, and each part's bytes are symbols of a doubly linked
list.  All neighbouring pairs that have a merge wait in a heap by (rank,
place); the first is merged, its neighbours' new pairs are pushed, and entries
whose symbols have changed meanwhile are skipped when they come up.  Decoding
concatenates the vocabulary's byte strings and reads them as UTF-8.

The ids equal those of the tokenizers library for the same file (tested on
random and odd texts and on the code points below 0x3000).  Texts are cut into
units (``Units``); each is encoded once per worker and remembered, in a space
bounded in bytes.
Spark deals out the rows; nothing is shuffled.  Null texts are empty: no ids.
Repeated rows, and rows that repeat an id or have none, each get their row; a
very long text is one row of one task; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import Memo, col, map_batches, table, text_of, worker_state
from .token_counts import slices

#: White space (the Unicode property), as inside a character class.
SPACE = "\t-\r \x85\xa0  -     　"
#: Parts that the pattern below never joins: what is between white space with
#: one space before it, or white space.
CHUNKS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


@cache
def unicode_class(kind: str) -> str:
    """The code points of a general category (its first letter), as inside a
    character class."""
    points = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == kind]
    starts = [c for i, c in enumerate(points) if not i or points[i - 1] != c - 1]
    ends = [c for i, c in enumerate(points) if i + 1 == len(points) or points[i + 1] != c + 1]
    return "".join(re.escape(chr(a)) + "-" + re.escape(chr(b)) for a, b in zip(starts, ends))


@cache
def pattern() -> re.Pattern:
    """Contractions; letters, numbers or others with a space before them; and
    white space, whose last one before a word stays with the word if a space."""
    letter, number = unicode_class("L"), unicode_class("N")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{SPACE}{letter}{number}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable ones themselves, the others 256 and up in turn."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, more = [""] * 256, 256
    for b in range(256):
        out[b] = chr(b if b in shown else more)
        more += b not in shown
    return out


_WHITE, _LETTER, _DIGIT, _MARK, _WIDE = range(5)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[list(b" \t\n\v\f\r")] = _WHITE
_CLASS[list(b"0123456789")] = _DIGIT
_CLASS[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = _LETTER
_CLASS[128:] = _CLASS[ord("'")] = _WIDE  # contractions have an apostrophe
#: White space beyond ASCII.
WIDE_SPACE = re.compile(f"[{''.join(c for c in SPACE if c > chr(127))}\u2000-\u200a]")


def cut_units(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The units of UTF-8 texts without special strings and white space beyond
    ASCII, and the number of each one's text.  A unit is a run of letters, of
    digits or of marks, with the space before it; or white space as in
    ``CHUNKS``.  Words with an apostrophe or other characters than ASCII and the
    letters of Latin-1 (the pairs C3 80 to C3 BF but for two signs) are units as a
    whole."""
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = len(data)
    kind = _CLASS[data]
    wide = np.flatnonzero(data[:-1] == 0xC3)
    wide = wide[(data[wide + 1] != 0x97) & (data[wide + 1] != 0xB7)]
    kind[wide] = kind[wide + 1] = _LETTER
    first = np.zeros(n + 1, bool)  # of a text
    first[0] = first[ends] = True
    change = first[:n].copy()
    change[1:] |= kind[1:] != kind[:-1]
    at = np.flatnonzero(change)  # runs of one kind
    white = kind[at] == _WHITE
    after = np.r_[False, white[:-1]] & ~first[at] & ~white  # runs after white space
    word = after | (first[at] & ~white)
    number = np.cumsum(word) - 1
    whole = np.zeros(int(word.sum()) + 1, bool)
    whole[number[kind[at] == _WIDE]] = True
    cut = np.zeros(n, bool)
    cut[at[white | (word & ~(after & (data[at - 1] == 32))) | (~white & ~word & ~whole[number])]] = True
    cut[at[after] - 1] = True  # the last white space goes with the word if a space
    starts = np.flatnonzero(cut)
    units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, n).astype(np.int32)), pa.py_buffer(data))
    return units, np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, ends), prepend=0))


class Units:
    """Texts as units that the vocabulary's pattern never joins: its special
    strings, and units of ``cut_units`` or, for texts with special strings or
    white space beyond ASCII, parts of ``CHUNKS``."""

    def __init__(self, special: dict[str, int]):
        self.special = special
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None

    def split(self, text: str) -> list[str]:
        if not any(s in text for s in self.special):
            return CHUNKS.findall(text)
        return [c for piece in self.cut.split(text) for c in ([piece] if piece in self.special else CHUNKS.findall(piece))]

    def ids(self, texts: list[str], memo: Memo, compute_many: Callable[[list], list], kind: str) -> Iterator[np.ndarray]:
        """Each text's ids, from its units' ids."""
        odd = [any(s in t for s in self.special) or not t.isascii() and WIDE_SPACE.search(t) is not None for t in texts]
        plain = [t.encode() for t, o in zip(texts, odd) if not o]
        cut = iter(memo.joined_array(*cut_units(plain), len(plain), compute_many, kind))
        split = iter(memo.joined([self.split(t) for t, o in zip(texts, odd) if o], compute_many, kind))
        return (next(split if o else cut) for o in odd)


class BytePairs:
    """A byte-level BPE vocabulary of a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        vocab = data["model"]["vocab"]
        symbols = byte_symbols()
        byte_of = {c: b for b, c in enumerate(symbols)}
        self.byte_ids = [vocab[c] for c in symbols]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"])
        self.size = max(vocab.values()) + 1
        self.ranks: dict[int, int] = {}  # by left * size + right
        self.made: list[int] = []
        for rank, (a, b) in enumerate(pairs):
            self.ranks[vocab[a] * self.size + vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in data["added_tokens"]):
            raise ValueError("special strings with options aren't supported")
        self.bytes_of |= {i: text.encode() for text, i in self.special.items()}
        self.digits = {i: str(i) for i in self.bytes_of}
        self.cut = Units(self.special)
        self.parts, self.units = Memo(self.merge, 8 << 20), Memo(self.unit, 24 << 20)

    def merge(self, part: str) -> bytes:
        """Ids of one part of the pattern, as 32-bit numbers."""
        ids = [self.byte_ids[b] for b in part.encode()]
        n, size, rank_of = len(ids), self.size, self.ranks.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [rank * n + i for i in range(n - 1) if (rank := rank_of(ids[i] * size + ids[i + 1])) is not None]
        heapify(queue)
        while queue:
            rank, i = divmod(heappop(queue), n)
            j = after[i]
            if j == n or rank_of(ids[i] * size + ids[j]) != rank:
                continue  # stale: one of the two has been merged meanwhile
            ids[i] = new = self.made[rank]
            ids[j] = -1  # no pair with it has a rank
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := rank_of(new * size + ids[k])) is not None:
                    heappush(queue, rank * n + i)
            if (h := before[i]) >= 0 and (rank := rank_of(ids[h] * size + new)) is not None:
                heappush(queue, rank * n + h)
        return array("i", [x for x in ids if x >= 0]).tobytes()

    def unit(self, unit: str) -> bytes:
        if unit in self.special:
            return array("i", [self.special[unit]]).tobytes()
        parts = pattern().findall(unit)
        return self.merge(unit) if len(parts) == 1 else b"".join(map(self.parts.__getitem__, parts))

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        for some in slices(texts):
            for ids in self.cut.ids(some, self.units, lambda units: list(map(self.unit, units)), "i"):
                yield ids.tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def loaded(path: str) -> BytePairs:
    """This worker's vocabulary of a file."""
    return worker_state(("bpe", path), lambda: BytePairs(path))


def encode_documents(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids) of every row."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs, out, lists = loaded(path), [], []
        for ids in pairs.encode(batch.column("text").to_pylist()):
            out.append((len(ids), hashlib.sha256(",".join(map(pairs.digits.__getitem__, ids)).encode()).hexdigest(),
                        hashlib.sha256(pairs.decode(ids).encode()).hexdigest()))
            if with_ids:
                lists.append(pa.array(ids, pa.int32()))
        n, a, b = zip(*out) if out else ((), (), ())
        columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            ends = [0]
            for x in lists:
                ends.append(ends[-1] + len(x))
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(lists) if lists else pa.array([], pa.int32())))
            names.append("ids")
        return pa.record_batch(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    texts = docs.select(col(docs, "doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return map_batches(texts, rows, schema)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
