"""Explicit-clock time helpers: every window is relative to ``as_of``."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AsOf = datetime | str


def to_datetime(as_of: AsOf) -> datetime:
    return as_of if isinstance(as_of, datetime) else datetime.fromisoformat(as_of)


def time_literal(df: DataFrame, ts: str, value: AsOf) -> Column:
    """A constant of the same timestamp type as ``df[ts]``; ``value`` is in UTC.

    Being a foldable cast of a string, it reaches the Parquet scan as a pushed
    filter for both timestamp types.
    """
    text = to_datetime(value).isoformat(sep=" ")
    kind = df.schema[ts].dataType
    return F.lit(f"{text}Z" if isinstance(kind, T.TimestampType) else text).cast(kind)


def trailing_window(df: DataFrame, as_of: AsOf, ts: str = "ts", **interval) -> DataFrame:
    """Rows with ``as_of - interval <= ts <= as_of``.

    ``interval`` takes the keywords of ``timedelta``. The upper bound keeps a
    re-run for a past ``as_of`` equal to the first run.
    """
    now = to_datetime(as_of)
    since = now - timedelta(**interval)
    col = F.col(ts)
    return df.filter(
        (col >= time_literal(df, ts, since)) & (col <= time_literal(df, ts, now))
    )


def age_seconds(df: DataFrame, as_of: AsOf, ts: str = "ts") -> Column:
    """Whole seconds between ``ts`` and ``as_of``."""
    return F.timestamp_diff("SECOND", F.col(ts), time_literal(df, ts, as_of))


def bucket_start(ts: str, width: str) -> Column:
    """Start of the tumbling window that holds ``ts``; keeps the input type."""
    return F.window(F.col(ts), width)["start"]
