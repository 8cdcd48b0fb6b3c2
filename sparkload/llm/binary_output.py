"""Token ids as length-delimited binary records, with an index of offsets.

A data file is a sequence of frames, as in TFRecord files: the payload's
length (unsigned 64 bits), the masked CRC-32C of those eight bytes, the
payload, its masked CRC-32C; all little-endian.  A payload is one document's
ids and the end id, as unsigned 16-bit numbers when the vocabulary fits in
them, else 32-bit.  Beside each data file lies an index: doc_id, offset and
payload length of each frame (signed 64 bits each; a null id is the smallest
number), so a shuffled reader can seek to any document.

Documents are dealt out by a range shuffle on doc_id and the start of the text
and sorted within their partition (nulls first, ties by text), so files in the
order of the manifest hold ascending ids and an id that many rows share is
split.  A task writes under names of its own and reports them in
the manifest, which Spark commits: files that the manifest doesn't name, from
lost or repeated attempts, are not part of the output.  A file is closed at
``FILE_BYTES``.  The folder may be on any store that pyarrow opens.

Reading deals out the manifest's files; every frame is checked against both
checksums, the index and the manifest, and a mismatch raises.  Null texts are
empty: the end id alone.  Repeated rows are written as often as they occur.  A
very long text is one frame; an empty table gives no files and no rows; other
columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..context import scratch_path
from .bpe import Units
from .common import Memo, col, map_partitions, stored, table, text_of, worker_state
from .token_counts import load, slices

FILE_BYTES = 256 << 20
#: Bytes of the units that a worker remembers, twice (Memo).
MEMO = 240 << 20
#: Characters whose units are looked up at a time.
SLICE = 4_000_000
END_ID = 0
SPLIT_CHARS = 40
NO_ID = -(1 << 63)
MANIFEST = "part int, file int, path string, width int, n_records long, n_ids long, n_bytes long"
_WIDTH = 1024  # bytes that one table lookup covers


@cache
def _crc_tables() -> tuple[list[int], np.ndarray]:
    """CRC-32C of a byte, and of a byte at each distance from the end of a
    block, from the polynomial 0x82F63B78."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0x82F63B78), one >> 1)
    rows = [one]
    for _ in range(_WIDTH - 1):
        rows.append(one[rows[-1] & 0xFF] ^ (rows[-1] >> 8))
    return one.tolist(), np.stack(rows[::-1]).ravel()


_PLACES = (np.arange(_WIDTH, dtype=np.int64) * 256)[None, :]


def crc32c(data: bytes) -> int:
    """CRC-32C.  A checksum is linear in the bytes, so whole blocks are looked
    up byte by byte at once and joined; the start value is folded into the
    first four bytes, and zeros before the data change nothing."""
    one, far = _crc_tables()
    if len(data) < 64:
        crc = 0xFFFFFFFF
        for b in data:
            crc = one[(crc ^ b) & 0xFF] ^ (crc >> 8)
        return crc ^ 0xFFFFFFFF
    n = -(-len(data) // _WIDTH)
    padded = np.zeros(n * _WIDTH, np.uint8)
    padded[len(padded) - len(data):] = np.frombuffer(data, np.uint8)
    padded[len(padded) - len(data):][:4] ^= 0xFF
    crc = 0
    for block in np.bitwise_xor.reduce(far[_PLACES + padded.reshape(n, _WIDTH)], axis=1).tolist():
        if crc:
            block ^= int(far[crc & 0xFF] ^ far[256 + (crc >> 8 & 0xFF)] ^ far[512 + (crc >> 16 & 0xFF)] ^ far[768 + (crc >> 24)])
        crc = block
    return crc ^ 0xFFFFFFFF


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(crc32c(length))), payload, struct.pack("<I", masked(crc32c(payload)))))


def read_frame(data) -> bytes | None:
    """The next payload of an open file, None at its end; a frame that is cut
    short or fails a checksum raises."""
    head = data.read(12)
    if not head:
        return None
    if len(head) < 12 or masked(crc32c(head[:8])) != struct.unpack("<I", head[8:])[0]:
        raise ValueError("damaged frame length")
    n = struct.unpack("<Q", head[:8])[0]
    body = data.read(n + 4)
    if len(body) < n + 4 or masked(crc32c(body[:n])) != struct.unpack("<I", body[n:])[0]:
        raise ValueError("damaged frame")
    return body[:n]


class Encoder:
    """Texts to bytes of ids by the tokenizers library.  The vocabulary's
    pattern never joins ``Units``, so each different unit is encoded once and
    remembered, in bounded space.  Units to encode go to the library as lines: a
    line end is a unit, and an id, of its own."""

    def __init__(self, path: str):
        tokenizer = load(path)
        self.special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.width = 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.cut = Units(self.special)
        self.kind = "<u2" if self.width == 2 else "<u4"
        self.encode = lambda texts: [np.array(e.ids, self.kind) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        self.line_end = self.encode(["\n"])[0]
        self.memo = Memo(lambda part: self.many([part])[0], MEMO)

    def many(self, parts: list[str]) -> list[bytes]:
        """The ids of each part."""
        lone = [p for p in parts if p.isspace() or p in self.special]
        out = dict(zip(lone, (ids.tobytes() for ids in self.encode(lone))))
        rest = [p for p in parts if p not in out]
        groups = [rest[i:i + 500] for i in range(0, len(rest), 500)]
        for group, ids in zip(groups, self.encode(["\n".join(g) for g in groups])):
            ends = np.flatnonzero(ids == self.line_end[0])
            if len(self.line_end) != 1 or len(ends) != len(group) - 1:
                raise ValueError("this vocabulary has no id of its own for a line end")
            at, data = [-self.width, *(ends * self.width).tolist(), len(ids) * self.width], ids.tobytes()
            out |= {p: data[a + self.width:b] for p, a, b in zip(group, at, at[1:])}
        return [out[p] for p in parts]

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        for some in slices(texts, SLICE):
            for ids in self.cut.ids(some, self.memo, self.many, self.kind):
                yield ids.tobytes()


def encoder(path: str) -> Encoder:
    return worker_state(("records", path), lambda: Encoder(path))


def open_store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def write_records(spark: SparkSession, docs: DataFrame, path: str, folder: str, end_id: int = END_ID,
                  file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes data and index files to ``folder`` and returns the manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, (store, root) = encoder(path), open_store(folder)
        store.create_dir(root, recursive=True)
        part, own, done = TaskContext.get().partitionId(), uuid.uuid4().hex[:12], []
        end, data, index = end_id.to_bytes(encode.width, "little"), None, None
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist())):
                if data is None:
                    name = f"part-{part:06d}-{len(done):04d}-{own}"
                    data, index = (store.open_output_stream(f"{root}/{name}.{kind}", buffer_size=1 << 20) for kind in ("rec", "idx"))
                    at, n, n_ids = 0, 0, 0
                payload = ids + end
                framed = frame(payload)
                data.write(framed)
                index.write(struct.pack("<qqq", NO_ID if doc_id is None else doc_id, at, len(payload)))
                at, n, n_ids = at + len(framed), n + 1, n_ids + len(payload) // encode.width
                if at >= file_bytes:
                    data.close(), index.close()
                    done.append((part, len(done), name, encode.width, n, n_ids, at))
                    data = None
        if data is not None:
            data.close(), index.close()
            done.append((part, len(done), name, encode.width, n, n_ids, at))
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.record_batch([pa.array([row[i] for row in done], k) for i, k in enumerate(kinds)], [c.split()[0] for c in MANIFEST.split(", ")])

    rows = docs.select(col(docs, "doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    # The start of the text splits an id, or the nulls, that many rows have.
    rows = rows.repartitionByRange("doc_id", F.substring("text", 1, SPLIT_CHARS)).sortWithinPartitions("doc_id", "text")
    return stored(spark, map_partitions(rows, write, MANIFEST), "record_manifest")


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every frame of the manifest's
    files.  Where files start is summed over the manifest, one row per file."""
    before = F.sum("n_ids").over(W.orderBy("part", "file").rowsBetween(W.unboundedPreceding, -1))
    files = manifest.withColumn("start", F.coalesce(before, F.lit(0)).cast("long"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for row in (r for batch in batches for r in batch.to_pylist()):
            at, start, n, out = 0, row["start"], 0, []
            with store.open_input_stream(f"{root}/{row['path']}.rec", buffer_size=1 << 20) as data, store.open_input_stream(f"{root}/{row['path']}.idx", buffer_size=1 << 16) as index:
                while (payload := read_frame(data)) is not None:
                    doc_id, offset, size = struct.unpack("<qqq", index.read(24))
                    if (offset, size) != (at, len(payload)):
                        raise ValueError(f"index and data differ at {at} of {row['path']}")
                    ids = np.frombuffer(payload, "<u2" if row["width"] == 2 else "<u4").astype("<u4")
                    out.append((None if doc_id == NO_ID else doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                    at, start, n = at + size + 16, start + len(ids), n + 1
                    if len(out) == 10_000:
                        yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)
                        out = []
            if (n, at, start - row["start"]) != (row["n_records"], row["n_bytes"], row["n_ids"]):
                raise ValueError(f"manifest and {row['path']} differ")
            if out:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)

    return map_partitions(files.repartition(max(1, manifest.count())), read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "llm", "records")
    manifest = write_records(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_records(manifest, folder)
