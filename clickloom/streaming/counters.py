"""Counters and histories whose keys expire some time after their last write.

A key lives as long as no two writes are further apart than its time to live;
after a longer pause it starts anew. Rows are kept by day, and a time to live is
a day or more, so the days of a key tell its pauses exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.functions.ranking import top_n_per_group
from clickloom.functions.times import AsOf, time_literal
from clickloom.operators import aggregates, windows
from clickloom.sources import keyed
from clickloom.streaming.stateful import product_actions

TOTAL = "total_interactions"


@dataclass(frozen=True)
class Counter:
    """Counts per ``fields`` of an ``entity``, which expires as a whole."""

    entity: tuple[str, ...]
    fields: tuple[str, ...]
    ttl: int


COUNTERS = {
    "product_counters": Counter(("product_id",), ("action",), keyed.TTL["product_stats"]),
    "profile_counters": Counter(("user_id", "kind"), ("value",), keyed.TTL["user_profile"]),
    "recommendation_clicks": Counter(("product_id",), (), keyed.TTL["recommendation_stats"]),
}


def counted(events: DataFrame, name: str) -> DataFrame:
    """One row with time ``ts`` for each count that an event makes."""
    if name == "product_counters":
        return product_actions(events)
    if name == "profile_counters":
        return aggregates.profile_entries(events)
    return aggregates.clicked_recommendations(events)


def increments(events: DataFrame, name: str) -> DataFrame:
    """Counts by entity, field and day with the first and last time."""
    counter = COUNTERS[name]
    rows = counted(events, name).where("ts is not null")
    return _summed(rows.withColumns({"event_date": F.to_date("ts"), "n": F.lit(1).cast("long"), "first_ts": F.col("ts"), "last_ts": F.col("ts")}), counter)


def _summed(rows: DataFrame, counter: Counter) -> DataFrame:
    return rows.groupBy(*counter.entity, *counter.fields, "event_date").agg(
        F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")
    )


def _last_life(rows: DataFrame, keys: Sequence[str], ttl: int, as_of: AsOf) -> DataFrame:
    """Rows (with first_ts, last_ts) of the life of each key that goes on at ``as_of``."""
    if ttl < keyed.DAY:
        raise ValueError("a time to live below a day is finer than the stored days")
    now = time_literal(rows, "last_ts", as_of)
    seen = rows.where(F.col("first_ts") <= now)
    days = seen.groupBy(*keys, "event_date").agg(F.min("first_ts").alias("_first"), F.max("last_ts").alias("_last"))
    # a row per key and day: windows stay small also for a very busy key
    before = F.lag("_last").over(Window.partitionBy(*keys).orderBy("event_date"))
    pause = F.expr(f"INTERVAL {int(ttl)} SECONDS")
    begins = F.when(before.isNull() | (F.col("_first") > before + pause), F.col("_first"))
    lives = days.withColumn("_begins", begins).groupBy(*keys).agg(
        F.max("_begins").alias("_life"), F.max("_last").alias("_end")
    )
    lives = lives.where(F.col("_end") + pause >= now)
    lives = lives.select(*[F.col(k).alias(f"_{k}") for k in keys], "_life")
    same = F.expr(" and ".join(f"{k} <=> _{k}" for k in keys))
    joined = seen.join(lives, same & (F.col("first_ts") >= F.col("_life")))
    return joined.select(*seen.columns)


def live_counters(rows: DataFrame, counter: Counter, as_of: AsOf) -> DataFrame:
    """``count`` per entity and field of the increments of live entities.

    Product actions come with a ``total_interactions`` row beside them.
    """
    alive = _last_life(rows, counter.entity, counter.ttl, as_of)
    keys = [*counter.entity, *counter.fields]
    by_field = alive.groupBy(*keys).agg(F.sum("n").alias("count"))
    if counter.fields != ("action",):
        return by_field
    total = by_field.groupBy(*counter.entity).agg(F.sum("count").alias("count"))
    return by_field.unionByName(total.withColumn("action", F.lit(TOTAL)))


def store_counters(events: DataFrame, root: str, batch_id: int, writer: str) -> None:
    for name, counter in COUNTERS.items():
        keyed.publish_version(increments(events, name), f"{root}/{name}", counter.entity, batch_id, writer)


def read_counters(spark: SparkSession, root: str, name: str, as_of: AsOf) -> DataFrame:
    """Live totals of the counters stored by the router."""
    rows = keyed.history(spark, f"{root}/{name}")
    if rows is None:
        raise FileNotFoundError(f"{root}/{name}")
    return live_counters(rows, COUNTERS[name], as_of)


def fold_counters(spark: SparkSession, root: str, name: str, as_of: AsOf) -> None:
    """Sum the stored increments by day and drop expired lives."""
    counter = COUNTERS[name]

    def fold(rows: DataFrame) -> DataFrame:
        alive = _summed(_last_life(rows, counter.entity, counter.ttl, as_of), counter)
        return alive.withColumns({"_writer": F.lit(keyed.BASE), "_version": F.lit(0).cast("long")})

    keyed.compact_versions(spark, f"{root}/{name}", counter.entity, fold)


# ---------------------------------------------------------------- histories


def store_history(events: DataFrame, root: str, kind: str, batch_id: int, writer: str) -> None:
    entries = windows.bounded_history(events, kind).drop("rank")
    keyed.publish_version(entries, f"{root}/history/{kind}", ["user_id"], batch_id, writer)


def live_history(entries: DataFrame, kind: str, as_of: AsOf) -> DataFrame:
    """Newest entries per user of the lists that live on, ranked from 1.

    The time to live is the list's and renewed by each entry: an entry stays as
    long as no pause after it was longer, however old it is.
    """
    keep = windows.HISTORIES[kind][1]
    rows = entries.where(F.col("ts") <= time_literal(entries, "ts", as_of))
    newest = top_n_per_group(
        rows, ["user_id"], windows.newest_first("ts", "event_id"), keep, spread_by="event_id"
    )
    # at most ``keep`` rows per user from here on
    in_order = Window.partitionBy("user_id").orderBy("rank")
    after = F.coalesce(F.lag("ts").over(in_order), time_literal(entries, "ts", as_of))
    pause = F.col("ts") + F.expr(f"INTERVAL {keyed.TTL[kind]} SECONDS") < after
    return newest.withColumn("_pause", pause.cast("int")).withColumn(
        "_pauses", F.sum("_pause").over(in_order)
    ).where("_pauses = 0").drop("_pause", "_pauses")


def read_history(spark: SparkSession, root: str, kind: str, as_of: AsOf) -> DataFrame:
    """``live_history`` of the entries stored by the router."""
    rows = keyed.history(spark, f"{root}/history/{kind}")
    if rows is None:
        raise FileNotFoundError(f"{root}/history/{kind}")
    return live_history(rows.drop("_writer", "_version", "_late"), kind, as_of)


def fold_history(spark: SparkSession, root: str, kind: str, as_of: AsOf) -> None:
    def fold(rows: DataFrame) -> DataFrame:
        alive = live_history(rows.drop("_writer", "_version", "_late"), kind, as_of).drop("rank")
        return alive.withColumns({"_writer": F.lit(keyed.BASE), "_version": F.lit(0).cast("long")})

    keyed.compact_versions(spark, f"{root}/history/{kind}", ["user_id"], fold)
