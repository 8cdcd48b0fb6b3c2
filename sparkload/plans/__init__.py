"""Manifests, load jobs (G1-G4), the load report (G5) and plan checks."""

from .jobs import Loader, window_predicate
from .manifest import (
    Extract,
    TableSpec,
    Window,
    full_load_manifest,
    incremental_manifest,
    insert_update_manifest,
    records_manifest,
    reference_manifest,
)
from .report import REPORT_SCHEMA, LoadResult, report_frame

__all__ = [
    "REPORT_SCHEMA",
    "Extract",
    "LoadResult",
    "Loader",
    "TableSpec",
    "Window",
    "full_load_manifest",
    "incremental_manifest",
    "insert_update_manifest",
    "records_manifest",
    "reference_manifest",
    "report_frame",
    "window_predicate",
]
