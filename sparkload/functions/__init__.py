"""Scalar functions: time literals (X3-X6), windows (F1-F9), text."""

from .text import clean_text, sanitize, string_columns
from .timestamps import add_months, at_least, at_most, epoch_of_ntz, epoch_seconds, ts_literal
from .windows import (
    CREATION_FLOOR,
    INSERT_CUTOFF,
    POLL_CUTOFF,
    Marks,
    created_since,
    cutoff_bound,
    last_n_years,
    last_n_years_bound,
    month_start_bound,
    month_to_date,
    month_to_date_epoch,
    rolling_update,
    watermark_delta,
)

__all__ = [
    "CREATION_FLOOR",
    "INSERT_CUTOFF",
    "POLL_CUTOFF",
    "Marks",
    "add_months",
    "at_least",
    "at_most",
    "clean_text",
    "created_since",
    "cutoff_bound",
    "epoch_of_ntz",
    "epoch_seconds",
    "last_n_years",
    "last_n_years_bound",
    "month_start_bound",
    "month_to_date",
    "month_to_date_epoch",
    "rolling_update",
    "sanitize",
    "string_columns",
    "ts_literal",
    "watermark_delta",
]
