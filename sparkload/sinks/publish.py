"""Putting a finished output in place in one step, and small state files.

A dated file is written beside its place first, under a hidden name on the same
store (``staged_path``); ``publish`` then swaps it in:

1. a small note beside the place names the finished copy: from here on it is
   the day's output, for ``current_path`` and for the next run;
2. the old folder is renamed away, the new one renamed into place;
3. the note and the old folder go.

A run that dies before step 1 leaves the old day in place; one that dies later
leaves a complete day under the name that ``current_path`` returns, and the next
run (``settle``) finishes the swap.  At no point is the day's only copy
incomplete.  Several outputs go in under one note (``publish_all``): a family
is then seen whole or not at all through ``current_path``, and a swap that
was cut off is finished for all of it.

Renames are a store's own (one step on HDFS and local disks, copies within the
store elsewhere); data never passes through the driver.  Names start with an
underscore, which Spark's readers skip.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

NOTE = ".next"


def _split(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent, name


def _beside(path: str, suffix: str) -> str:
    parent, name = _split(path)
    return f"{parent}/_{name}{suffix}" if parent else f"_{name}{suffix}"


def staged_path(path: str) -> str:
    """A new hidden folder beside ``path``, on the same store."""
    return _beside(path, f".{uuid.uuid4().hex[:12]}")


class Store:
    """The few file operations of a Hadoop file system that publishing needs."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def rename(self, old: str, new: str) -> None:
        fs, p = self._at(old)
        if not fs.rename(p, self._at(new)[1]):
            raise OSError(f"cannot rename {old} to {new}")

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def write(self, path: str, text: str) -> None:
        """A small file, complete or not there: written aside and renamed."""
        aside = _beside(path, f".{uuid.uuid4().hex[:12]}")
        fs, p = self._at(aside)
        out = fs.create(p, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self.exists(path):
            self.delete(path)
        self.rename(aside, path)

    def read(self, path: str) -> str | None:
        """A small file's text, ``None`` if it is not there."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        data = fs.open(p)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(data)).decode()
        finally:
            data.close()

    def names(self, folder: str) -> list[str]:
        """Names in a folder (empty if it is not there)."""
        fs, p = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _swap(store: Store, staged: str, path: str) -> None:
    """Steps 2 of ``publish``; may be run again wherever it was cut off."""
    if not store.exists(staged):
        return  # already in place
    old = _beside(path, ".old")
    if store.exists(path):
        if store.exists(old):
            store.delete(old)
        store.rename(path, old)
    store.rename(staged, path)


def publish_all(spark: SparkSession, outputs: Sequence[tuple[str, str]]) -> None:
    """Swap in several finished copies, as (staged, path), all or none."""
    store = Store(spark)
    for _, path in outputs:
        settle(spark, path)
    first = _beside(outputs[0][1], NOTE)
    for _, path in outputs[1:]:
        store.write(_beside(path, NOTE), json.dumps({"see": first}))
    store.write(first, json.dumps([list(o) for o in outputs]))  # from here on all of them count
    _finish(store, outputs)


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Swap in one finished copy."""
    publish_all(spark, [(staged, path)])


def _finish(store: Store, outputs: Sequence[tuple[str, str]]) -> None:
    for staged, path in outputs:
        _swap(store, staged, path)
    for _, path in reversed(list(outputs)):  # the deciding note goes last
        store.delete(_beside(path, NOTE))
        store.delete(_beside(path, ".old"))


def _noted(store: Store, path: str) -> list[tuple[str, str]] | None:
    """The outputs of the swap that ``path`` is part of, if it has begun."""
    text = store.read(_beside(path, NOTE))
    found = json.loads(text) if text else None
    if isinstance(found, dict) and "see" in found:
        text = store.read(found["see"])
        found = json.loads(text) if text else None
    return [tuple(o) for o in found] if isinstance(found, list) else None


def settle(spark: SparkSession, path: str) -> None:
    """Finishes a swap that an earlier run left behind, or drops the notes of
    one that had not begun."""
    store = Store(spark)
    outputs = _noted(store, path)
    if outputs:
        _finish(store, outputs)
    elif store.exists(_beside(path, NOTE)):
        store.delete(_beside(path, NOTE))


def current_path(spark: SparkSession, path: str) -> str:
    """Where the complete output of ``path`` is: the path itself, but for the
    finished copy while a swap is under way."""
    store = Store(spark)
    for staged, at in _noted(store, path) or ():
        if at == path and store.exists(staged):
            return staged
    return path
