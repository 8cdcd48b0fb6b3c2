"""Command line: run one of the four load jobs of the reference manifest.

    python -m sparkload run --job full --sources sources.json \\
        --output-root s3a://bucket --as-of 2024-03-15T06:00:00 --time-zone America/New_York

``--job`` is ``full`` (G1), ``insert_update`` (G2), ``incremental`` (G3) or
``records`` (G4); ``--tables`` limits the run to some tables.  The report
(G5) is printed as JSON lines and, with ``--report``, written as parquet.
With ``--ledger`` each extract's result is kept as it ends, and ``--resume``
with the same ``--as-of`` runs only what is left.
The exit code is 1 if any extract failed.  Scheduling (the reference's
time-of-day gates) belongs to the scheduler that calls this command.

``python -m sparkload explain --job ... --sources ...`` prints each
extract's formatted physical plan (push-down, pruning, exchanges) without
running it: it reads schemas, the partition bounds of partitioned JDBC
tables and one landed record's keys for CRM objects, and writes nothing.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from .context import RunContext, apply_scale_conf, build_session
from .plans import manifest as mf
from .plans.jobs import Loader
from .plans.report import lost, report_frame
from .sources.config import registry_from_json

MANIFESTS = {
    "full": mf.full_load_manifest,
    "insert_update": mf.insert_update_manifest,
    "incremental": mf.incremental_manifest,
    "records": mf.records_manifest,
}


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="sparkload")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="run a load job")
    run.add_argument("--job", choices=sorted(MANIFESTS), required=True)
    run.add_argument("--sources", required=True, help="JSON file binding source names to readers")
    run.add_argument("--output-root", required=True)
    run.add_argument("--as-of", help="run instant, ISO format, wall clock in --time-zone (default: now)")
    run.add_argument("--time-zone", default="UTC")
    run.add_argument("--tables", help="comma-separated table names to run (default: all)")
    run.add_argument("--format", choices=("csv", "parquet"), default="csv")
    run.add_argument("--parallel", type=int, default=4, help="extracts submitted at once")
    run.add_argument("--salt-buckets", type=int, default=None, help="explicit salting of large cascades")
    run.add_argument("--records-layout", choices=("lines", "pages", "whole_pages"), default="lines")
    run.add_argument("--stage-overwrites", action=argparse.BooleanOptionalAction, default=True,
                     help="write dated files beside their place and swap them in when complete (the default)")
    run.add_argument("--whole-families", action="store_true", help="publish a parent and its children together or not at all")
    run.add_argument("--ledger", help="folder that keeps each extract's result as it ends")
    run.add_argument("--resume", action="store_true", help="leave out what the ledger has as done for this --as-of")
    run.add_argument("--report", help="write the report as parquet here")
    run.add_argument("--master", default=None)
    sub.add_parser("manifest", help="print the reference manifest as JSON lines")
    ex = sub.add_parser("explain", help="print each extract's physical plan without running it")
    ex.add_argument("--job", choices=sorted(MANIFESTS), required=True)
    ex.add_argument("--sources", required=True, help="JSON file binding source names to readers")
    ex.add_argument("--as-of", help="run instant, ISO format (default: now)")
    ex.add_argument("--time-zone", default="UTC")
    ex.add_argument("--tables", help="comma-separated table names (default: all)")
    ex.add_argument("--master", default=None)
    return p.parse_args(argv)


# Extracts whose plan depends on results of the run (marks, key sets).
RUN_TIME_PLANS = {"increment": "needs the warehouse's marks", "cascade": "needs the parent's key set",
                  "semi_static": "needs the parent's key set"}


def explain(loader: Loader, specs: list, out=None) -> None:
    """The formatted physical plan of each extract, built lazily: schemas,
    JDBC partition bounds are read, nothing is
    written."""
    from .plans.explain import plan_text
    out = out or sys.stdout
    for spec in specs:
        print(f"== {spec.job} {spec.schema}.{spec.name} ({spec.extract.value}, {spec.layout.value})", file=out)
        if spec.extract.value in RUN_TIME_PLANS:
            print(f"   planned at run time: {RUN_TIME_PLANS[spec.extract.value]}", file=out)
            continue
        try:
            print(plan_text(loader.frame(spec), "formatted"), file=out)
        except Exception as e:
            print(f"   cannot plan: {type(e).__name__}: {str(e).strip()}", file=out)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    if args.command == "manifest":
        for spec in mf.reference_manifest():
            print(json.dumps({"job": spec.job, "schema": spec.schema, "table": spec.table,
                              "extract": spec.extract.value, "layout": spec.layout.value,
                              "sanitize": spec.sanitize, "output": spec.name}))
        return 0
    from zoneinfo import ZoneInfo
    if args.command == "explain":
        as_of = (dt.datetime.fromisoformat(args.as_of) if args.as_of
                 else dt.datetime.now(ZoneInfo(args.time_zone)).replace(tzinfo=None))
        spark = build_session("sparkload-explain", args.master)
        ctx = RunContext(as_of=as_of, time_zone=args.time_zone, output_root="")
        explain(Loader(spark, ctx, registry_from_json(args.sources)), _selected(MANIFESTS[args.job](), args.tables))
        return 0
    as_of = (dt.datetime.fromisoformat(args.as_of) if args.as_of
             else dt.datetime.now(ZoneInfo(args.time_zone)).replace(tzinfo=None))
    spark = build_session(f"sparkload-{args.job}", args.master)
    apply_scale_conf(spark, args.time_zone)
    specs = _selected(MANIFESTS[args.job](), args.tables)
    ctx = RunContext(as_of=as_of, time_zone=args.time_zone, output_root=args.output_root)
    loader = Loader(spark, ctx, registry_from_json(args.sources), output_format=args.format,
                    max_parallel=args.parallel, salt_buckets=args.salt_buckets, records_layout=args.records_layout,
                    stage_overwrites=args.stage_overwrites, whole_families=args.whole_families,
                    ledger=args.ledger, resume=args.resume)
    results = loader.run(specs)
    for r in results:
        print(json.dumps(r.__dict__, default=str))
    if args.report:
        report_frame(spark, results).write.mode("errorifexists").parquet(args.report)
    return 1 if any(lost(r) for r in results) else 0


def _selected(specs: list, tables: str | None) -> list:
    if not tables:
        return specs
    wanted = {t.strip() for t in tables.split(",")}
    return [s for s in specs if s.table in wanted or s.name in wanted]


if __name__ == "__main__":
    sys.exit(main())
