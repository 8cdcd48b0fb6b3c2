"""Small helpers shared by the operators of this package.

Every operator reads the columns it needs by name and ignores the others, so
extra columns never clash with the names of its results.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import scratch_path

#: Words of most operators: runs of anything but ASCII white space.
#: ``bytes.split()`` cuts at exactly these six bytes.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(df: DataFrame, name: str) -> Column:
    """A column by its exact name (dots and spaces included)."""
    return df[f"`{name}`"]


def text_of(df: DataFrame, name: str = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(col(df, name), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared scratch folder and read
    back: a cut of the lineage that survives lost executors."""
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_ROWS = 1000
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def map_partitions(df: DataFrame, rows: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` for a function that uses this package.  Workers import
    it where it is installed, or else from the driver's path to it.  What a task
    leaves unused in Arrow's pool goes back to the system at its end."""
    packed, root = cloudpickle.dumps(rows), ROOT
    function = hashlib.md5(packed).hexdigest()

    def run(batches):
        import sys

        from pyspark import cloudpickle as unpack

        if root not in sys.path:
            sys.path.append(root)
        from sparkload.llm.common import begin_task

        begin_task(function)
        try:
            yield from unpack.loads(packed)(batches)
        finally:
            import pyarrow

            pyarrow.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, rows: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``map_partitions`` by batches of at most ``BATCH_ROWS`` rows, so that a
    worker holds the strings and results of few rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                yield rows(batch.slice(at, BATCH_ROWS))

    return map_partitions(df, run, schema)


_state: list = [None, None]
_function: list = [None]


def begin_task(function: str) -> None:
    """Lets go of what tasks of another function have kept in this worker, as
    the next operator may keep nothing itself."""
    if _function[0] != function:
        _function[0] = function
        _state[:] = None, None


def worker_state(key, make: Callable):
    """What a worker keeps between tasks (a loaded vocabulary and its memo), of
    one ``key`` at a time: a worker that goes on to another operator's tasks
    lets go of the last one's."""
    if _state[0] != key:
        _state[:] = None, None
        _state[:] = key, make()
    return _state[1]


class Memo(dict):
    """A memo of ``compute(key)`` in bounded space: two generations of at most
    ``size`` bytes each, the older one dropped when the younger is full.
    Frequent keys move over, so they stay; a dropped key is only computed
    again.  Keys of over ``LONG`` characters are never kept."""

    LONG = 64
    #: Bytes of an entry besides its characters: the objects and the table's place.
    ENTRY = 200

    def __init__(self, compute: Callable, size: int = 48 << 20):
        self.compute, self.size, self.used, self.old = compute, size, 0, {}

    def keep(self, key, value) -> None:
        length = len(key) if isinstance(key, str) else 8
        cost = self.ENTRY + 2 * length + (len(value) if isinstance(value, bytes) else 8)
        if length > self.LONG or cost > self.size // 64:
            return
        if self.used + cost > self.size:
            self.old = dict(self)
            self.clear()
            self.used = 0
        self[key] = value
        self.used += cost

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self.keep(key, value)
        return value

    def values_of(self, keys: list, compute_many: Callable[[list], list]) -> list:
        """The values of different ``keys``; the missing ones are computed in
        one call."""
        found = list(map(self.get, keys))
        new = [i for i, v in enumerate(found) if v is None]
        for i in new:
            found[i] = self.old.get(keys[i])
        missing = [i for i in new if found[i] is None]
        if missing:
            for i, value in zip(missing, compute_many([keys[i] for i in missing]), strict=True):
                found[i] = value
        self.keep_all([keys[i] for i in new], [found[i] for i in new])
        return found

    def keep_all(self, keys: list, values: list) -> None:
        """``keep`` for many; at once where they are texts and bytes that fit."""
        if keys and isinstance(values[0], bytes):
            short = [(k, v) for k, v in zip(keys, values) if len(k) <= self.LONG]
            cost = self.ENTRY * len(short) + sum(2 * len(k) + len(v) for k, v in short)
            if self.used + cost > self.size and cost <= self.size:
                self.old = dict(self)
                self.clear()
                self.used = 0
            if self.used + cost <= self.size:
                self.update(short)
                self.used += cost
                return
        for k, v in zip(keys, values):
            self.keep(k, v)

    def of(self, parts: list[list[str]], compute_many: Callable[[list], list]) -> tuple[list, np.ndarray, np.ndarray]:
        """For lists of strings: the values of their different strings, and
        for each string in turn the number of its value and of its list."""
        flat = pa.array([p for some in parts for p in some], pa.string())
        lists = np.repeat(np.arange(len(parts)), np.fromiter(map(len, parts), np.int64, len(parts)))
        return self.of_array(flat, lists, compute_many)

    def of_array(self, flat: pa.Array, lists: np.ndarray, compute_many: Callable[[list], list]) -> tuple[list, np.ndarray, np.ndarray]:
        flat = flat.dictionary_encode()
        return self.values_of(flat.dictionary.to_pylist(), compute_many), flat.indices.to_numpy(), lists

    def joined(self, parts: list[list[str]], compute_many: Callable[[list], list], kind: str) -> list[np.ndarray]:
        """For each list, its strings' values one after another; the values
        are bytes of numbers of a numpy ``kind``."""
        return self._joined(*self.of(parts, compute_many), len(parts), kind)

    def joined_array(self, flat: pa.Array, lists: np.ndarray, n_lists: int, compute_many: Callable[[list], list], kind: str) -> list[np.ndarray]:
        """The same for an array of all strings and the number of each one's list."""
        return self._joined(*self.of_array(flat, lists, compute_many), n_lists, kind)

    @staticmethod
    def _joined(values: list, at: np.ndarray, lists: np.ndarray, n_lists: int, kind: str) -> list[np.ndarray]:
        size = np.fromiter(map(len, values), np.int64, len(values)) // np.dtype(kind).itemsize
        numbers, n = np.frombuffer(b"".join(values), kind), size[at]
        places = np.repeat((np.cumsum(size) - size)[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        ends = np.cumsum(np.bincount(lists, n, n_lists).astype(np.int64))
        return np.split(numbers[places], ends[:-1])
