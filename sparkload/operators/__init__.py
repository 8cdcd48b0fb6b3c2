"""Relational operators: projection (P2-P5), distinct (A1/A2), increments
(A3, F7/F8, J1-J4), counting (A4) and lineage cuts."""

from .counting import observe_rows
from .distinct import distinct_by_digest, distinct_keys, distinct_rows
from .incremental import cascade, delta, delta_keys, read_marks, watermark
from .intervals import key_intervals
from .materialize import KeySet, materialize, materialize_keys
from .projection import drop_envelope, resolve_columns, select_columns, with_derived
from .semijoin import DEFAULT_MAX_BROADCAST_KEYS, hot_keys, semi_join

__all__ = [
    "DEFAULT_MAX_BROADCAST_KEYS",
    "KeySet",
    "cascade",
    "delta",
    "delta_keys",
    "distinct_by_digest",
    "distinct_keys",
    "distinct_rows",
    "drop_envelope",
    "hot_keys",
    "key_intervals",
    "materialize",
    "materialize_keys",
    "observe_rows",
    "read_marks",
    "resolve_columns",
    "select_columns",
    "semi_join",
    "watermark",
    "with_derived",
]
