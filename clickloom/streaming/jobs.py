"""Streaming jobs: the event router, the list refresh and the session table.

Each job is one ``foreachBatch`` query with a checkpoint. A batch writes only
directories or versions named after the stream and its batch id and reads none
of them, so a replayed batch replaces its own output and nothing else. The clock
of a batch is its newest event time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions.times import AsOf
from clickloom.operators import projections, windows
from clickloom.plans.refresh import refresh_recommendations
from clickloom.sources import keyed, sinks
from clickloom.streaming import counters
from clickloom.streaming.stateful import session_activity

TRIGGER = "30 seconds"
STORED = (
    "user_id bigint, product_ids array<bigint>, "
    "updated_at timestamp_ntz, expires_at timestamp_ntz"
)
SESSIONS = (
    "session_id string, user_id bigint, last_activity timestamp, created_at timestamp, "
    "updated_at timestamp_ntz, expires_at timestamp_ntz"
)


def batch_time(batch: DataFrame) -> datetime | None:
    """Newest event time of a micro-batch (one-row aggregate), in UTC."""
    newest = F.max("ts")
    if isinstance(batch.schema["ts"].dataType, T.TimestampType):
        newest = F.to_utc_timestamp(newest, F.current_timezone())
    newest = batch.agg(F.date_format(newest, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).first()["t"]
    return None if newest is None else datetime.fromisoformat(newest)


def start_batches(
    stream: DataFrame,
    body: Callable[[DataFrame, int, str], None],
    name: str,
    checkpoint: str,
    available_now: bool = False,
    mode: str = "append",
) -> StreamingQuery:
    """Run ``body(batch, batch id, writer)``; the writer belongs to the checkpoint."""
    writer = keyed.writer_of(stream.sparkSession, checkpoint, name)
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(lambda batch, batch_id: body(batch, batch_id, writer))
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        return query.trigger(availableNow=True).start()
    return query.trigger(processingTime=TRIGGER).start()


# ------------------------------------------------------------------- router


def route_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    forward: Callable[[DataFrame, int], None] | None = None,
    writer: str = "router",
) -> None:
    """Store and count one batch of parsed events.

    Raw events, interactions, counter increments and history entries are
    appended under the batch id; rejects (rows without an event type) are kept
    with their text and without a time; ``forward`` receives the messages for
    the processing topic. Counters and histories are folded when they are read.

    Each sink counts the rows it writes while it writes them; ``sink_counts``
    keeps the counts beside that of the batch. Events and rejects together must
    be the batch, else the batch fails and is run again.
    """
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    seen: dict[str, Observation] = {}

    def counted(sink: str, rows: DataFrame) -> DataFrame:
        seen[sink] = Observation()
        return rows.observe(seen[sink], F.count(F.lit(1)).alias("rows"))

    try:
        events = batch.where("event_type is not null")
        rejects = batch.where("event_type is null").select("raw").withColumn("ts", F.lit(None).cast("timestamp_ntz"))
        sinks.append_batch(counted("rejected_events", rejects), f"{root}/rejected_events", batch_id, writer)
        sinks.append_raw_events(counted("raw_events", events), f"{root}/raw_events", batch_id, writer)
        sinks.append_interactions(
            counted("interactions", projections.to_interaction(events)), f"{root}/interactions", batch_id, writer
        )
        counts = {"input": batch.count()} | {sink: o.get.get("rows", 0) for sink, o in seen.items()}
        if counts["input"] != counts["raw_events"] + counts["rejected_events"]:
            raise ValueError(f"batch {batch_id} of {writer} lost rows: {counts}")
        table = [(sink, rows, None) for sink, rows in counts.items()]
        observed = batch.sparkSession.createDataFrame(table, "sink string, rows bigint, ts timestamp_ntz")
        sinks.append_batch(observed, f"{root}/sink_counts", batch_id, writer)
        counters.store_counters(events, root, batch_id, writer)
        for kind in windows.HISTORIES:
            counters.store_history(events, root, kind, batch_id, writer)
        if forward is not None:
            forward(sinks.as_messages(events), batch_id)
    finally:
        batch.unpersist()


def event_router(
    events: DataFrame,
    root: str,
    checkpoint: str,
    forward: Callable[[DataFrame, int], None] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """One pass over the event stream into all stores.

    ``events`` come from ``parse_events``, with ``rejects=True`` to have broken
    records stored, too.
    """
    return start_batches(
        events, lambda b, i, w: route_batch(b, i, root, forward, w), "router", checkpoint, available_now
    )


def fold_stores(spark: SparkSession, root: str, as_of: AsOf) -> None:
    """Fold the increments and entries of the router; for the batch job."""
    for name in counters.COUNTERS:
        counters.fold_counters(spark, root, name, as_of)
    for kind in windows.HISTORIES:
        counters.fold_history(spark, root, kind, as_of)


# ------------------------------------------------------------------ refresh


def refresh_batch(
    batch: DataFrame,
    batch_id: int,
    store: str,
    candidates: Callable[[], tuple[DataFrame, DataFrame]],
    writer: str = "refresh",
) -> None:
    """Refresh the lists of the users of one batch and publish them."""
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        as_of = batch_time(projections.important_events(batch))
        if as_of is None:
            return
        spark = batch.sparkSession
        stored = keyed.read_keyed(
            spark, store, ["user_id"], as_of, STORED, only=batch, before=(writer, batch_id)
        )
        trending, shelf = candidates()
        lists = refresh_recommendations(batch, stored, trending, shelf)
        keyed.publish_keyed(
            lists, store, ["user_id"], keyed.TTL["recommendations"], as_of, batch_id, writer
        )
    finally:
        batch.unpersist()


def stream_refresh(
    events: DataFrame,
    store: str,
    candidates: Callable[[], tuple[DataFrame, DataFrame]],
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep the stored lists fresh; ``candidates`` returns (trending, shelf)."""
    return start_batches(
        events, lambda b, i, w: refresh_batch(b, i, store, candidates, w), "refresh", checkpoint, available_now
    )


def store_lists(lists: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append the changed lists of ``refresh_state.stream_lists`` by batch id; a replayed batch replaces itself."""

    def body(batch: DataFrame, batch_id: int, writer: str) -> None:
        sinks.append_batch(batch, path, batch_id, writer, "updated_at")

    return start_batches(lists, body, "lists", checkpoint, available_now, mode="update")


def newest_lists(stored: DataFrame) -> DataFrame:
    """``user_id, product_ids, updated_at`` of each user's last batch."""
    last = F.max_by(F.struct("product_ids", "updated_at"), "batch_id")
    return stored.groupBy("user_id").agg(last.alias("_l")).select("user_id", "_l.*")


# ----------------------------------------------------------------- sessions


def session_batch(
    batch: DataFrame, batch_id: int, store: str, ttl: int = keyed.DAY, writer: str = "sessions"
) -> None:
    """Upsert the sessions seen in one batch; a late event never turns one back."""
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        as_of = batch_time(batch)
        if as_of is None:
            return
        new = session_activity(batch.withColumn("ts", F.col("ts").cast("timestamp")))
        new = new.persist(StorageLevel.MEMORY_AND_DISK)
        old = keyed.read_keyed(
            batch.sparkSession, store, ["session_id"], as_of, SESSIONS, only=new, before=(writer, batch_id)
        ).select(*new.columns)
        both = new.unionByName(old)
        merged = both.groupBy("session_id").agg(
            F.max_by("user_id", "last_activity").alias("user_id"),
            F.max("last_activity").alias("last_activity"),
            F.min("created_at").alias("created_at"),
        )
        keyed.publish_keyed(merged, store, ["session_id"], ttl, as_of, batch_id, writer)
        new.unpersist()
    finally:
        batch.unpersist()


def stream_sessions(
    events: DataFrame, store: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    return start_batches(
        events, lambda b, i, w: session_batch(b, i, store, writer=w), "sessions", checkpoint, available_now
    )


def publish_counts(
    counts: DataFrame, store: str, keys: Sequence[str], checkpoint: str, ttl: int, available_now: bool = False
) -> StreamingQuery:
    """Publish the changed rows of a running aggregate by key.

    A row lives ``ttl`` seconds from its ``last_ts`` on, the newest event that it counts.
    """

    def body(batch: DataFrame, batch_id: int, writer: str) -> None:
        keyed.publish_keyed(batch, store, keys, ttl, F.col("last_ts"), batch_id, writer)

    return start_batches(counts, body, "counts", checkpoint, available_now, mode="update")
