"""Results of a run, kept as each extract ends.

Each result is a small file of its own under ``<folder>/<run stamp>/``, so
extracts that end at the same time do not meet, and a driver that dies loses
none of them.  A rerun of the same instant reads them back: with ``resume`` the
extracts that ended well are not run again, and its report is complete.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict

from pyspark.sql import SparkSession

from ..context import join_path
from ..sinks.publish import Store
from .report import OK, LoadResult


class Ledger:
    def __init__(self, spark: SparkSession, folder: str, run_stamp: str):
        self.spark, self.folder = spark, join_path(folder, run_stamp)

    def add(self, result: LoadResult) -> None:
        key = json.dumps([result.job, result.schema_name, result.table_name, result.layout])
        name = hashlib.sha256(key.encode()).hexdigest()[:24]
        Store(self.spark).write(join_path(self.folder, f"{name}.json"), json.dumps(asdict(result)))

    def results(self) -> list[LoadResult]:
        """The last result of each extract so far."""
        store = Store(self.spark)
        texts = (store.read(join_path(self.folder, n)) for n in store.names(self.folder) if n.endswith(".json") and not n.startswith("_"))
        return [LoadResult(**json.loads(t)) for t in texts if t]

    def done(self) -> dict[tuple[str, str, str, str], LoadResult]:
        """Results of the extracts that ended well, by job, schema, table and
        layout."""
        return {(r.job, r.schema_name, r.table_name, r.layout): r for r in self.results() if r.status == OK}
