"""Load jobs G1-G4 over a manifest, with the report G5.

Every extract is one Spark job (scan → filter → project → clean → write);
nothing passes through the driver but the catalog names, the one-row
marks, key counts and the report.  Extracts are isolated: a failing table is
reported and the others go on.  Independent extracts run concurrently from
a small driver thread pool, so a large cluster is not left idle by a long
list of small tables (the reference runs them one after another).

The incremental job (G3) computes each parent delta **once**: it is written
to the shared checkpoint folder, the parent file is written from that copy
and its distinct keys are materialized next to it; every child semi-joins
to those keys.  Parent and children therefore see the same delta, and a
lost executor never re-reads a source that may have moved on.
"""

from __future__ import annotations

import threading
import time
from collections import defaultdict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, suppress

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from .. import functions as fn
from .. import operators as op
from ..context import SCALE_CONF, RunContext, spark_context
from ..functions.windows import Marks
from ..sinks import csv as csv_sink
from ..sinks.paths import FILE_EXTENSION, output_path, write_mode
from ..sinks.publish import Store, publish_all, settle, staged_path
from ..sources import records
from ..sources.catalog import existing_tables
from ..sources.registry import SourceRegistry
from .manifest import Extract, TableSpec, Window
from .ledger import Ledger
from .report import ERROR, MISSING, OK, SKIPPED, LoadResult, report_frame

#: Extracts that keep some of what they scan: their output is dealt out anew
#: before it is written, so its files do not number the scan's splits.
SELECTIVE = (Extract.WINDOW, Extract.SEMI_STATIC, Extract.INCREMENT, Extract.CASCADE)


def window_predicate(w: Window, df: DataFrame, ctx: RunContext) -> Column:
    """The ``Column`` of one window spec."""
    if w.kind == "month_to_date":
        return fn.month_to_date(df, w.column, ctx, w.cutoff)
    if w.kind == "month_to_date_epoch":
        return fn.month_to_date_epoch(df, w.column, ctx, w.cutoff)
    if w.kind == "rolling_update":
        return fn.rolling_update(df, w.column, w.created, ctx, w.days, w.floor, w.floor_months, w.cutoff)
    if w.kind == "created_since":
        return fn.created_since(df, w.column, w.floor, ctx)
    if w.kind == "last_n_years":
        return fn.last_n_years(df, w.column, ctx, w.years)
    raise ValueError(f"unknown window kind {w.kind!r}")


class Loader:
    """Runs manifests against a ``SourceRegistry`` for one ``RunContext``.

    Options: ``output_format`` ``"csv"`` (the reference's files) or
    ``"parquet"``; ``max_parallel`` extracts running at once, children of
    an increment included (each source may cap the reads it sees at once,
    ``SourceConfig.max_parallel_reads``);
    ``max_broadcast_keys`` the largest counted key set a cascade broadcasts;
    ``salt_buckets`` explicit salting of the hot keys of cascades above that
    bound (else AQE splits them); ``records_layout`` ``"lines"``, ``"pages"`` or ``"whole_pages"`` for
    landed CRM records; ``set_session_zone`` pins the session's time zone to
    the run's while it lasts; ``stage_overwrites`` (the default) writes dated files beside
    their place and swaps them in when they are complete (sinks/publish.py);
    without it a rerun whose read fails leaves that day without a file.
    ``rebalance`` (the default) shuffles the rows that a window or cascade has
    kept into files of the session's advisory size, hot ones split;
    ``whole_families`` publishes a parent and its children together or not at
    all; ``ledger`` (a folder) keeps each extract's result as it ends, and with
    ``resume`` an extract that it has as done is not run again.
    """

    def __init__(
        self,
        spark: SparkSession,
        ctx: RunContext,
        sources: SourceRegistry,
        *,
        output_format: str = "csv",
        max_parallel: int = 4,
        max_broadcast_keys: int = op.DEFAULT_MAX_BROADCAST_KEYS,
        salt_buckets: int | None = None,
        records_layout: str = "lines",
        set_session_zone: bool = True,
        stage_overwrites: bool = True,
        rebalance: bool = True,
        whole_families: bool = False,
        ledger: str | None = None,
        resume: bool = False,
    ):
        self.spark = spark
        self.ctx = ctx
        self.sources = sources
        self.output_format = output_format
        self.max_parallel = max(1, max_parallel)
        self.max_broadcast_keys = max_broadcast_keys
        self.salt_buckets = salt_buckets
        self.records_layout = records_layout
        self.stage_overwrites = stage_overwrites
        self.rebalance = rebalance
        self.whole_families = whole_families
        self.ledger = Ledger(spark, ledger, ctx.run_stamp) if ledger else None
        self.resume = resume
        self._slots = threading.BoundedSemaphore(self.max_parallel)
        self._settings = {k: v for k, v in SCALE_CONF.items() if k.startswith("spark.sql.adaptive.")}  # a hot key of a cascade is split
        if set_session_zone:
            # Timestamps are written as wall clock of the run's zone.
            self._settings["spark.sql.session.timeZone"] = ctx.time_zone

    @contextmanager
    def session(self):
        """The session with the run's settings; the caller's come back
        after it."""
        conf = self.spark.conf
        before = {k: conf.get(k, None) for k in self._settings}
        for k, v in self._settings.items():
            conf.set(k, v)
        try:
            yield self.spark
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)

    # -- reading -----------------------------------------------------------

    def read(self, spec: TableSpec, table: str | None = None) -> DataFrame:
        derived = dict(spec.derived) if spec.derived_in_source and table is None else None
        return self.sources.read(self.spark, spec.source, table or spec.table, derived=derived,
                                 partitioned=not spec.consistent_read, schema=spec.schema)

    def read_records(self, spec: TableSpec, seen: Observation | None = None) -> DataFrame:
        schema = spec.record_schema or records.string_fields(spec.columns or ())
        path = self.sources.path(spec.source, spec.table)
        return records.read_records(self.spark, path, schema, spec.columns, self.records_layout, seen)

    # -- plans -------------------------------------------------------------

    def frame(self, spec: TableSpec, marks: Marks | None = None,
              keys: op.KeySet | None = None, clean: bool = True, seen: Observation | None = None) -> DataFrame:
        """The lazy plan of one extract, ready to write (``clean=False``
        leaves out X1/X2)."""
        x = spec.extract
        df = self.read_records(spec, seen) if x is Extract.RECORDS else self.read(spec)
        if x in (Extract.WINDOW, Extract.RECORDS) and spec.window is not None:
            df = df.where(window_predicate(spec.window, df, self.ctx))
        if x is Extract.DISTINCT_KEYS:
            df = op.distinct_keys(df.where(window_predicate(spec.window, df, self.ctx)), spec.key)
        elif x is Extract.SEMI_STATIC:
            parent = self.read(spec, spec.parent)
            if spec.parent_window is not None:
                parent = parent.where(window_predicate(spec.parent_window, parent, self.ctx))
            pkeys = op.materialize_keys(self.spark, op.distinct_keys(parent, spec.key), spec.key,
                                        f"keys_{spec.parent}")
            df = self._distinct(spec, self._cascade(spec, df, pkeys, None))
        elif x is Extract.INCREMENT:
            df = self._distinct(spec, op.delta(df, marks, self.ctx, spec.created, spec.updated, spec.update_floor,
                                               distinct=False))
        elif x is Extract.CASCADE:
            own = fn.watermark_delta(df, marks, self.ctx, spec.created, spec.updated) if spec.own_delta else None
            df = self._distinct(spec, self._cascade(spec, df, keys, own))
        if spec.columns is not None and x is not Extract.RECORDS:
            df = op.select_columns(df, spec.columns)
        if spec.derived and not spec.derived_in_source:
            df = op.with_derived(df, dict(spec.derived))
        return fn.sanitize(df) if spec.sanitize and clean else df

    def _distinct(self, spec: TableSpec, df: DataFrame) -> DataFrame:
        """A1 ``select distinct`` over the extract's columns (projected
        first), unless a unique key is among them: then every row is
        already distinct and the shuffle would remove nothing.  The key is
        declared (``unique_key``) or the JDBC source's primary key."""
        if not spec.distinct:
            return df
        if spec.columns is not None:
            df = op.select_columns(df, spec.columns)
        key = spec.unique_key or self.sources.unique_key(self.spark, spec.source, spec.schema, spec.table)
        present = {c.lower() for c in df.columns}
        if key and all(k.lower() in present for k in key):
            return df
        return op.distinct_rows(df)

    def _cascade(self, spec: TableSpec, child: DataFrame, keys: op.KeySet, own: Column | None) -> DataFrame:
        return op.cascade(child, keys, spec.child_key, spec.key, own_delta=own,
                          distinct=False, max_broadcast_keys=self.max_broadcast_keys,
                          salt_buckets=self.salt_buckets,
                          text_ranges=self.sources.get(spec.source).format != "jdbc")

    # -- writing -----------------------------------------------------------

    def path(self, spec: TableSpec) -> str:
        p = output_path(self.ctx, spec.layout, spec.out_folder(), spec.name)
        return p.removesuffix(FILE_EXTENSION) + ".parquet" if self.output_format == "parquet" else p

    def write(self, spec: TableSpec, df: DataFrame, verify: Callable[[], None] | None = None) -> tuple[str, int]:
        """Writes the extract's file; ``verify`` runs once the source was
        read, before a staged copy is swapped in, and raises to fail it."""
        staged, path, rows = self.write_staged(spec, df, verify)
        if staged != path:
            publish_all(self.spark, [(staged, path)])
        return path, rows

    def write_staged(self, spec: TableSpec, df: DataFrame, verify: Callable[[], None] | None = None,
                     hold: bool = False) -> tuple[str, str, int]:
        """Writes the extract's file beside its place, where it overwrites one
        or is to be held back: (where it is, where it goes, rows)."""
        path, mode, known_rows = self.path(spec), write_mode(spec.layout), None
        if self.resume:  # a per-run file of this instant is one that was cut off
            mode = "overwrite"
        hold = (hold or (self.stage_overwrites and mode == "overwrite")) and spark_context(self.spark) is not None
        target = staged_path(path) if hold else path
        if hold:
            settle(self.spark, path)
            mode = "errorifexists"
        if spec.single_file and self.output_format != "parquet":
            # A single file's size check needs the count first; counting, then
            # writing, would read a possibly changing source twice.
            df, known_rows = op.materialize(self.spark, df, f"staged_{spec.name}")
        elif self.rebalance and not spec.distinct and (spec.extract in SELECTIVE or spec.window is not None):
            df = df.hint("rebalance")  # (a distinct has dealt its rows out)
        counted, obs = op.observe_rows(df, f"rows_{spec.name}_{spec.layout.value}")
        try:
            if self.output_format == "parquet":
                csv_sink.write_parquet(counted, target, mode)
            else:
                csv_sink.write_csv(counted, target, mode, single_file=spec.single_file, row_count=known_rows)
            rows = int(obs.get.get("rows", 0))
            if verify is not None:
                verify()
        except Exception:
            if hold:
                self._drop(target)
            raise
        return target, path, rows

    def _drop(self, staged: str) -> None:
        """Removes a copy that will not be published; what cannot be removed
        stays hidden beside the outputs."""
        with suppress(Exception):
            Store(self.spark).delete(staged)

    # -- running -----------------------------------------------------------

    def _result(self, spec, status, path=None, rows=None, error=None, t0=None) -> LoadResult:
        secs = None if t0 is None else round(time.time() - t0, 3)
        result = LoadResult(spec.job, spec.schema, spec.name, spec.layout.value, path, rows, status, error, secs)
        if self.ledger is not None:
            self.ledger.add(result)
        return result

    def _describe(self, spec: TableSpec) -> None:
        """Name the calling thread's jobs after the extract and put them in
        the extract's own scheduler pool (shared fairly under FAIR mode)."""
        sc = spark_context(self.spark)
        if sc is None:
            return
        sc.setJobDescription(f"sparkload {spec.job} {spec.schema}.{spec.name} {spec.layout.value}")
        sc.setLocalProperty("spark.scheduler.pool", pool_name(spec))

    def run_one(self, spec: TableSpec) -> LoadResult:
        t0 = time.time()
        seen = Observation() if spec.extract is Extract.RECORDS else None

        def fields_landed() -> None:
            absent = sorted(k for k, v in seen.get.items() if v is False)
            if absent:
                raise ValueError(f"no record has the fields {absent}")

        try:
            self._describe(spec)
            with self.sources.gate(spec.source), self._slots:
                df = self.frame(spec, seen=seen)
                path, rows = self.write(spec, df, fields_landed) if seen else self.write(spec, df)
            return self._result(spec, OK, path, rows, t0=t0)
        except Exception as e:  # isolate: report and go on
            return self._result(spec, ERROR, error=_message(e), t0=t0)

    def run_family(self, parent: TableSpec, children: list[TableSpec],
                   present: set[tuple[str, str, str]], failed: dict[tuple[str, str], str]) -> list[LoadResult]:
        """G3 for one parent and its children.

        The delta is materialized first; then the parent file, the key set and
        (once the keys exist) the children are written concurrently.  As in
        the reference, a failed parent read skips its children, while a failed
        parent write does not.
        """
        t0 = time.time()
        try:
            self._describe(parent)
            marks = self.sources.marks(self.spark, parent.target_source, parent.target_table,
                                       parent.created, parent.updated, self.ctx.time_zone)
            # The source is read once: the key comes along where the file
            # does not list it, and is dropped from the file.
            own_key = parent.columns is None or parent.key.lower() in {c.lower() for c in parent.columns}
            wide = parent if own_key else parent.but(columns=(*parent.columns, parent.key))
            with self.sources.gate(parent.source), self._slots:
                delta, _ = op.materialize(self.spark, self.frame(wide, marks=marks, clean=False),
                                          f"delta_{parent.name}")
            file_rows = delta
            if not own_key:
                file_rows = delta.drop(parent.key)
                file_rows = op.distinct_rows(file_rows) if parent.distinct else file_rows
        except Exception as e:
            return ([self._result(parent, ERROR, error=_message(e), t0=t0)]
                    + [self._result(c, SKIPPED, error=f"parent {parent.name} failed") for c in children])

        held: list[tuple[TableSpec, str, str, int, float]] = []

        def put(spec: TableSpec, frame: DataFrame, began: float) -> LoadResult | None:
            """The result of a written extract; ``None`` while it is held back."""
            if not self.whole_families:
                path, rows = self.write(spec, frame)
                return self._result(spec, OK, path, rows, t0=began)
            held.append((spec, *self.write_staged(spec, frame, hold=True), began))
            return None

        def parent_file() -> LoadResult | None:
            try:
                self._describe(parent)
                with self._slots:
                    return put(parent, fn.sanitize(file_rows) if parent.sanitize else file_rows, t0)
            except Exception as e:
                return self._result(parent, ERROR, error=_message(e), t0=t0)

        def one_child(child: TableSpec, keys: op.KeySet) -> LoadResult | None:
            t1 = time.time()
            if _catalog_of(child) in failed:
                return self._result(child, ERROR, error=failed[_catalog_of(child)], t0=t1)
            if _catalog_key(child) not in present:
                return self._result(child, MISSING, t0=t1)
            try:
                self._describe(child)
                with self.sources.gate(child.source), self._slots:
                    return put(child, self.frame(child.but(key=parent.key), marks=marks, keys=keys), t1)
            except Exception as e:
                return self._result(child, ERROR, error=_message(e), t0=t1)

        with ThreadPoolExecutor(self.max_parallel + 1) as pool:
            parent_done = pool.submit(parent_file)
            try:
                with self._slots:
                    keys = op.materialize_keys(self.spark, op.delta_keys(delta, parent.key), parent.key,
                                               f"keys_{parent.name}")
            except Exception as e:
                kids = [self._result(c, ERROR, error=f"keys of {parent.name} failed: {_message(e)}")
                        for c in children]
            else:
                kids = list(pool.map(lambda c: one_child(c, keys), children))
            members = [parent_done.result()] + kids
        return self._release([parent, *children], members, held) if self.whole_families else members

    def _release(self, specs: list[TableSpec], members: list[LoadResult | None],
                 held: list[tuple[TableSpec, str, str, int, float]]) -> list[LoadResult]:
        """Publishes a family's files together, or none if one of them failed."""
        broken = [r for r in members if r is not None and r.status == ERROR]
        error = f"not published: {broken[0].table_name} of its family failed" if broken else None
        for _, staged, _, _, _ in held if broken else ():
            self._drop(staged)
        if held and not error:
            try:
                publish_all(self.spark, [(staged, path) for _, staged, path, _, _ in held])
            except Exception as e:
                error = _message(e)
        by_name = {(h[0].name, h[0].layout): h for h in held}
        out = []
        for spec, r in zip(specs, members):
            if r is None:
                _, _, path, rows, began = by_name[spec.name, spec.layout]
                r = self._result(spec, SKIPPED if broken else ERROR, error=error, t0=began) if error else self._result(spec, OK, path, rows, t0=began)
            out.append(r)
        return out

    def present(self, specs: list[TableSpec]) -> tuple[set[tuple[str, str, str]], dict[tuple[str, str], str]]:
        """The (source, schema, name) found, and the error of each
        (source, schema) whose catalog could not be asked; only allow-listed
        names are looked up and collected."""
        failed: dict[tuple[str, str], str] = {}
        groups: dict[tuple[str, str, bool], list[str]] = defaultdict(list)
        for s in specs:
            if s.target_source:
                groups[(s.target_source, s.schema, True)].append(_catalog_name(s))
            else:
                try:
                    fold = self.sources.folds_case(self.spark, s.source)
                except Exception as e:
                    failed[_catalog_of(s)] = f"catalog of {s.source}: {_message(e)}"
                    continue
                groups[(s.source, s.schema, fold)].append(s.table)

        def lookup(group) -> set[tuple[str, str, str]]:
            (source, schema, fold), wanted = group
            wanted = list(dict.fromkeys(wanted))
            try:
                cat = self.sources.catalog(self.spark, source, schema, wanted, fold_case=fold)
                names = existing_tables(self.spark, cat, wanted, None, fold_case=fold)
            except Exception as e:  # the other sources go on
                failed[source, schema] = f"catalog of {source}: {_message(e)}"
                return set()
            return {(source, schema, n) for n in names}

        # One catalog query per source and schema, several at once.
        with ThreadPoolExecutor(max(1, min(8, len(groups)))) as pool:
            return set().union(*pool.map(lookup, groups.items())), failed

    def run(self, specs: list[TableSpec]) -> list[LoadResult]:
        """Run a manifest; returns one result per spec, in manifest
        order but for children, which follow their parent (those without one
        come last)."""
        with self.session():
            return self._run(specs)

    def _run(self, specs: list[TableSpec]) -> list[LoadResult]:
        done = self.ledger.done() if self.ledger is not None and self.resume else {}
        key = lambda s: (s.job, s.schema, s.name, s.layout.value)
        by_parent: dict[str, list[TableSpec]] = defaultdict(list)
        for s in specs:
            if s.extract is Extract.CASCADE:
                by_parent[s.parent].append(s)
        # A family is done as a whole: its members see one delta.
        family = lambda s: [s, *(by_parent.get(s.name, []) if s.extract is Extract.INCREMENT else [])]
        heads = [s for s in specs if s.extract is not Extract.CASCADE]
        finished = [s for s in heads if all(key(x) in done for x in family(s))]
        left = [x for s in heads if s not in finished for x in family(s)]
        present, failed = self.present(left)
        units = []
        for s in heads:
            if s in finished:
                units.append(("done", s))
            elif _catalog_of(s) in failed:
                units.append(("failed", s))
            elif _catalog_key(s) not in present:
                units.append(("missing", s))
            elif s.extract is Extract.INCREMENT:
                units.append(("family", s))
            else:
                units.append(("one", s))
        parents = {s.name for s in specs if s.extract is Extract.INCREMENT}
        orphans = [c for p, cs in by_parent.items() if p not in parents for c in cs]
        results: dict[int, list[LoadResult]] = {}

        def work(i_unit):
            i, (kind, s) = i_unit
            if kind == "done":
                return i, [done[key(x)] for x in family(s)]
            if kind == "failed":
                kids = by_parent.get(s.name, []) if s.extract is Extract.INCREMENT else []
                return i, [self._result(x, ERROR, error=failed[_catalog_of(s)]) for x in (s, *kids)]
            if kind == "missing":
                kids = by_parent.get(s.name, []) if s.extract is Extract.INCREMENT else []
                return i, [self._result(s, MISSING)] + [self._result(c, SKIPPED, error=f"parent {s.name} missing")
                                                        for c in kids]
            if kind == "family":
                return i, self.run_family(s, by_parent.get(s.name, []), present, failed)
            return i, [self.run_one(s)]

        with ThreadPoolExecutor(self.max_parallel) as pool:
            for i, res in pool.map(work, enumerate(units)):
                results[i] = res
        ordered = [r for i in sorted(results) for r in results[i]]
        ordered += [self._result(c, SKIPPED, error=f"no parent {c.parent} in manifest") for c in orphans]
        return ordered

    def report(self, specs: list[TableSpec]) -> DataFrame:
        return report_frame(self.spark, self.run(specs))


def pool_name(spec: TableSpec) -> str:
    """Scheduler pool of one extract."""
    return f"sparkload.{spec.job}.{spec.schema}.{spec.name}.{spec.layout.value}"


def _catalog_name(spec: TableSpec) -> str:
    return (spec.target_table or spec.table).lower() if spec.target_source else spec.table


def _catalog_of(spec: TableSpec) -> tuple[str, str]:
    """The source and schema whose catalog lists the extract's table."""
    return spec.target_source or spec.source, spec.schema


def _catalog_key(spec: TableSpec) -> tuple[str, str, str]:
    return (*_catalog_of(spec), _catalog_name(spec))


def _message(e: Exception) -> str:
    """The whole error text, for the report."""
    return f"{type(e).__name__}: {str(e).strip()}"
