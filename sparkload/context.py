"""Run context and session helpers.

``RunContext`` is the only clock in the library: every window bound, path
suffix and watermark literal is derived from ``as_of`` on the driver, so a
run is repeatable and testable (no ``current_date()`` inside a plan).
"""

from __future__ import annotations

import datetime as dt
import re
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Session settings the jobs rely on at scale.  ``forceOptimizeSkewedJoin``
# lets AQE split a hot semi-join key even when the split needs one extra
# exchange for the ``distinct`` that follows it (see operators/semijoin.py).
SCALE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    # Extracts run as concurrent jobs, each in its own scheduler pool
    # (plans/jobs.py).  FAIR shares executors between the pools, so the
    # jobs of small tables are not queued behind a large table's tasks as
    # they are under FIFO.  Static: takes effect when the session starts.
    "spark.scheduler.mode": "FAIR",
}


@dataclass(frozen=True)
class RunContext:
    """The run instant, its time zone and the output root.

    ``as_of`` is a naive wall-clock datetime in ``time_zone``; it stands for
    MySQL's ``sysdate()`` and ``datetime.now()`` of the run.
    """

    as_of: dt.datetime
    time_zone: str = "UTC"
    output_root: str = ""
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])

    def __post_init__(self) -> None:
        """The run instant has whole seconds, as the source's ``sysdate()``."""
        object.__setattr__(self, "as_of", self.as_of.replace(microsecond=0))

    @property
    def day(self) -> dt.date:
        """``curdate()``: the calendar day of the run."""
        return self.as_of.date()

    @property
    def day_stamp(self) -> str:
        """Date suffix of dated files, ``yyyymmdd``."""
        return self.as_of.strftime("%Y%m%d")

    @property
    def run_stamp(self) -> str:
        """Suffix of per-run files, ``yyyymmddHHMMSS`` (no colons: object
        stores and HDFS reject ``:`` in a path segment)."""
        return self.as_of.strftime("%Y%m%d%H%M%S")

    def with_as_of(self, as_of: dt.datetime) -> "RunContext":
        return RunContext(as_of, self.time_zone, self.output_root, self.run_id)


def build_session(
    app_name: str = "sparkload",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings of ``SCALE_CONF`` plus ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SCALE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_scale_conf(spark: SparkSession, time_zone: str | None = None) -> None:
    """Set the runtime-settable (``spark.sql.*``) parts of ``SCALE_CONF`` on
    a live session; the others only apply when a session is built."""
    for key, value in SCALE_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    if time_zone:
        spark.conf.set("spark.sql.session.timeZone", time_zone)


def spark_context(spark: SparkSession):
    """The session's ``SparkContext``, or ``None`` for a Spark Connect
    session, which has none (job descriptions and pools are then skipped)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint directory).  Only a local-mode session (tests; one process on
    one machine) with neither set gets a fresh temporary folder; on any
    cluster, a ``local-cluster`` of several processes included, a machine-local
    folder would not survive executor loss, so the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark_context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is None or not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="sparkload-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique folder under ``scratch_root`` (never reused, never
    cleared: each call gets its own token)."""
    token = uuid.uuid4().hex[:16]
    return "/".join([scratch_root(spark), "sparkload", *parts, token])


def join_path(root: str, *parts: str) -> str:
    """Join URI or path segments with ``/``."""
    pieces = [root.rstrip("/")] if root else []
    pieces += [p.strip("/") for p in parts if p]
    return "/".join(pieces)


def local_frame(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A small driver-side table (catalog names, report rows) as literals in
    the plan: ``inline(array(struct(...)))``.  Unlike ``createDataFrame`` on
    a Python list it needs no Python worker.  Only for data bounded by the
    manifest, never for table data."""
    struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in struct.fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, struct.fields)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
