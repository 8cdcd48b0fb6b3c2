"""Plan checks: what ``explain`` shows about push-down, pruning and Python.

Used by tests and the bench to keep each extract's plan the one wanted:
window bounds in ``PushedFilters``, only needed columns in ``ReadSchema``,
semi joins as ``LeftSemi``, and no Python evaluation node anywhere.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[(.*)\]", plan_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*>)", plan_text(df))


def python_nodes(df: DataFrame) -> list[str]:
    text = plan_text(df, "extended")
    return [n for n in PYTHON_NODES if n in text]


def exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges in the physical plan."""
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)",
                          plan_text(df, "simple")))
