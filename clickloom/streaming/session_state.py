"""Sessions that end by an event-time timer."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: A tab without a heartbeat for so long has ended.
IDLE = timedelta(minutes=5)
CLOSED = "session_id string, started_at timestamp, last_activity timestamp, heartbeats bigint"
#: Sessions share the state of one of so many groups; a checkpoint keeps the number that it began with.
BUCKETS = 1 << 12
STATE = "session_ids array<string>, started array<bigint>, last array<bigint>, heartbeats array<bigint>"
PIECES = "session_id string, minute bigint, first timestamp, ts timestamp, n bigint"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Heartbeats of a session and minute as one row, so that a busy tab sends few rows on."""
    for got in batches:
        table = pa.Table.from_batches([got]).group_by(["session_id", "minute"])
        table = table.aggregate([("ts", "min"), ("ts", "max"), ("ts", "count")])
        names = ["session_id", "minute", "ts_min", "ts_max", "ts_count"]
        table = table.select(names).rename_columns(["session_id", "minute", "first", "ts", "n"])
        yield from table.combine_chunks().to_batches()


def closed_sessions(
    heartbeats: DataFrame, idle: timedelta = IDLE, delay: str = "10 minutes", buckets: int = BUCKETS
) -> DataFrame:
    """``session_id, started_at, last_activity, heartbeats`` of each session when it has ended; for append mode.

    A session goes on while heartbeats come at most ``idle`` after the one
    before (at least a minute). An open session is three numbers in the state
    of its bucket, so the calls of a micro-batch are bounded by ``buckets``,
    not by sessions; a timer at the first end in a bucket emits what the
    watermark has passed. Heartbeats without a session or time are left out.
    """
    if idle < timedelta(minutes=1):
        raise ValueError("a session stays open for a minute at least")
    rows = heartbeats.where("session_id is not null and ts is not null")
    ts = F.col("ts").cast("timestamp")
    rows = rows.select("session_id", F.floor(F.unix_micros(ts) / 60_000_000).alias("minute"), ts.alias("ts"))
    rows = rows.mapInArrow(_pieces, PIECES).withWatermark("ts", delay)
    micros = lambda c: F.unix_micros(c)
    bucket = F.pmod(F.xxhash64("session_id"), F.lit(buckets)).alias("bucket")
    rows = rows.select(bucket, "session_id", "ts", micros("first").alias("begin"), micros("ts").alias("end"), "n")
    span = idle // timedelta(microseconds=1)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        opened = {s: tuple(x) for s, *x in zip(*state.get, strict=True)} if state.exists else {}
        columns = ["session_id", "begin", "end", "n"]
        pieces = [] if state.hasTimedOut else sorted(
            p for f in frames for p in zip(*(f[c].tolist() for c in columns), strict=True)
        )
        found = []
        for session, begin, end, n in pieces:
            now = opened.get(session)
            if now is None or begin > now[1] + span:
                if now is not None:
                    found.append((session, *now))
                opened[session] = (begin, end, n)
            else:
                opened[session] = (min(begin, now[0]), max(end, now[1]), now[2] + n)
        watermark = state.getCurrentWatermarkMs()
        ended = [s for s, now in opened.items() if (now[1] + span) // 1000 <= watermark]
        found += [(s, *opened.pop(s)) for s in ended]
        if opened:
            state.update((list(opened), *map(list, zip(*opened.values(), strict=True))))
            state.setTimeoutTimestamp((min(now[1] for now in opened.values()) + span) // 1000)
        elif state.exists:
            state.remove()
        if found:
            out = pd.DataFrame(found, columns=["session_id", "started_at", "last_activity", "heartbeats"])
            yield out.assign(**{c: pd.to_datetime(out[c], unit="us", utc=True) for c in out.columns[1:3]})

    return rows.groupBy("bucket").applyInPandasWithState(
        update, CLOSED, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
