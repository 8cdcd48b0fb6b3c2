"""Load row count (A4) without a second scan.

``DataFrame.observe`` attaches a ``count`` to the plan; the metric is filled
by the same job that writes the file.  Metrics of failed or retried task
attempts are not merged, so the count is exact under executor loss.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observe_rows(df: DataFrame, name: str | None = None) -> tuple[DataFrame, Observation]:
    """Return ``df`` with a row counter attached and its ``Observation``;
    read ``obs.get["rows"]`` after an action on the returned frame."""
    # Unique per call: jobs of one session may run at the same time.
    obs = Observation(f"{name or 'rows'}_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
