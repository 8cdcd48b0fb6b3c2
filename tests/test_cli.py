"""Command line over the reference manifest, with a lake folder as source."""

from __future__ import annotations

import json
import os

from conftest import SF_SMALL

from sparkload import cli
from sparkload.sources.config import registry_from_dict


def test_full_job_from_command_line(spark, outdir, capsys):
    sources = os.path.join(outdir, "sources.json")
    doc = {name: {"format": "parquet", "root": SF_SMALL}
           for name in ("smc", "billing-service", "sslvpn", "vcoloburst", "vcenter-new", "call_metrics",
                        "shift_report", "power-etl")}
    with open(sources, "w") as f:
        json.dump(doc, f)
    out = os.path.join(outdir, "bucket")
    code = cli.main(["run", "--job", "full", "--sources", sources, "--output-root", out,
                     "--as-of", "2024-03-15T06:00:00", "--tables", "customer,region,tag"])
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    status = {r["table_name"]: r["status"] for r in lines}
    assert code == 0 and status == {"customer": "ok", "region": "ok", "tag": "missing"}
    assert os.path.isdir(os.path.join(out, "mysql_backups", "smc", "customer", "customer20240315.csv"))


def test_config_expands_environment(monkeypatch):
    monkeypatch.setenv("SPARKLOAD_TEST_PW", "s3cret")
    reg = registry_from_dict({"smc": {"format": "jdbc", "options": {"url": "jdbc:x", "password": "${SPARKLOAD_TEST_PW}"},
                                      "partitioning": {"ticket": {"column": "id", "num_partitions": 8}}}})
    cfg = reg.get("smc")
    assert cfg.options["password"] == "s3cret" and cfg.partitioning["ticket"].num_partitions == 8


def test_manifest_listing(capsys):
    assert cli.main(["manifest"]) == 0
    rows = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert len(rows) == 164
    assert sum(r["job"] == "full" for r in rows) == 135


def test_run_options_reach_the_loader(monkeypatch, outdir):
    """Flags of ``run`` become Loader settings (the run itself is stubbed)."""
    from sparkload.plans import jobs
    seen = {}

    class FakeLoader:
        def __init__(self, spark, ctx, sources, **kw):
            seen.update(kw, as_of=ctx.as_of, zone=ctx.time_zone)

        def run(self, specs):
            seen["tables"] = sorted({s.table for s in specs})
            return []

    monkeypatch.setattr(cli, "Loader", FakeLoader)
    monkeypatch.setattr(cli, "build_session", lambda *a, **k: None)
    monkeypatch.setattr(cli, "apply_scale_conf", lambda *a, **k: None)
    sources = os.path.join(outdir, "sources.json")
    with open(sources, "w") as f:
        json.dump({"smc": {"format": "parquet", "root": SF_SMALL}}, f)
    code = cli.main(["run", "--job", "incremental", "--sources", sources, "--output-root", outdir,
                     "--as-of", "2024-03-15T06:00:00", "--time-zone", "Europe/Berlin", "--tables", "asset,asset_ip_info",
                     "--format", "parquet", "--parallel", "6", "--salt-buckets", "16", "--records-layout", "pages",
                     "--stage-overwrites"])
    assert code == 0 and jobs.Loader is not FakeLoader
    assert seen["output_format"] == "parquet" and seen["max_parallel"] == 6 and seen["salt_buckets"] == 16
    assert seen["records_layout"] == "pages" and seen["stage_overwrites"] is True
    assert seen["zone"] == "Europe/Berlin" and seen["tables"] == ["asset", "asset_ip_info"]


def test_explain_prints_plans_without_running(spark, outdir, capsys):
    sources = os.path.join(outdir, "sources.json")
    with open(sources, "w") as f:
        json.dump({"smc": {"format": "parquet", "root": SF_SMALL}}, f)
    code = cli.main(["explain", "--job", "full", "--sources", sources, "--as-of", "2024-03-15T06:00:00",
                     "--tables", "customer,ticket_asset,tag"])
    out = capsys.readouterr().out
    assert code == 0
    assert "== full smc.customer (snapshot, snapshot)" in out and "Scan parquet" in out
    assert "== full smc.ticket_asset (semi_static, snapshot)\n   planned at run time" in out
    assert "== full smc.tag" in out and "cannot plan" in out  # not in the folder
    assert sorted(os.listdir(outdir)) == ["sources.json"]  # nothing written beside the config
