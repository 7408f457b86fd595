"""The list refresh with native state: one bounded list per user, kept by Spark.

The state of a user is the last list and its time, kept with those of the other
users of a bucket. It ends by an event-time timer, or when the user comes back
after the list's life.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from clickloom.functions import scalars
from clickloom.operators import lists, projections
from clickloom.operators.aggregates import PROFILE_CATEGORY_TYPES

#: How long a list lives after its user's newest event.
LIFE = timedelta(days=3)
ENTRIES = "user_id bigint, category string, product_id bigint, n bigint, ts timestamp"
LISTS = "user_id bigint, product_ids array<bigint>, updated_at timestamp"
#: Users share the state of one of so many groups; a checkpoint keeps the number that it began with.
BUCKETS = 1 << 10
STATE = "user_ids array<bigint>, product_ids array<array<bigint>>, updated array<bigint>"


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal entries of a batch of rows as one, so a very active user sends few rows on."""
    for got in batches:
        keys = ["user_id", "category", "product_id"]
        table = pa.Table.from_batches([got]).group_by(keys).aggregate([("n", "sum"), ("ts", "max")])
        table = table.rename_columns([*keys, "n", "ts"]) if table.column_names[0] == "user_id" else table
        yield from table.select([*keys, "n", "ts"]).combine_chunks().to_batches()


def interest_entries(events: DataFrame) -> DataFrame:
    """``user_id, category, product_id, n, ts`` of the events that matter for a list."""
    rows = projections.important_events(events).where("user_id is not null and ts is not null")
    counts = F.col("event_type").isin(*PROFILE_CATEGORY_TYPES)
    category = F.nullif(F.try_element_at("data", F.lit("category")), F.lit(""))
    rows = rows.select(
        F.col("user_id").cast("bigint"),
        F.when(counts, category).alias("category"),
        F.when(counts, scalars.product_id_of(F.col("data")).cast("bigint")).alias("product_id"),
        F.lit(1).cast("bigint").alias("n"),
        F.col("ts").cast("timestamp"),
    )
    return rows.mapInArrow(_combined, ENTRIES)


def next_list(trending: list[int], counts: dict, picks: dict, seen: set, old: list[int]) -> list[int]:
    """Fresh candidates, the strongest interest first, before the old list."""
    ordered = list(trending)
    for category in sorted(counts, key=lambda c: (-counts[c], c)):
        ordered += picks.get(category, [])
    fresh = [p for p in dict.fromkeys(ordered) if p not in seen][: lists.MAX_CANDIDATES]
    return list(dict.fromkeys([*fresh, *old]))[: lists.MAX_LIST]


def stream_lists(
    events: DataFrame,
    trending: DataFrame,
    shelf: DataFrame,
    life: timedelta = LIFE,
    delay: str = "10 minutes",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Per micro-batch the new list of each of its users; for update mode.

    ``trending(product_id, rank)`` and ``shelf(category, product_id, rank)`` are
    tables; the few best trending products are read once, a category's best come
    by a join. The lists equal those of ``refresh_recommendations`` on the
    batch's events and the user's list so far, if it is not older than ``life``.
    The calls of a micro-batch are bounded by ``buckets``, not by users.
    """
    best = trending.where(F.col("rank") <= lists.TRENDING_CANDIDATES).orderBy("rank").select("product_id")
    popular = [r.product_id for r in best.limit(lists.TRENDING_CANDIDATES).collect()]
    ranked = F.array_sort(F.collect_list(F.struct("rank", "product_id")))["product_id"]
    shelves = shelf.where(F.col("rank") <= lists.PER_CATEGORY_CANDIDATES).groupBy("category").agg(ranked.alias("picks"))
    rows = interest_entries(events).join(shelves, "category", "left").withWatermark("ts", delay)
    bucket = F.pmod(F.xxhash64("user_id"), F.lit(buckets)).alias("bucket")
    at = F.unix_micros("ts").alias("at")
    rows = rows.select(bucket, "user_id", "category", "product_id", "n", "ts", at, "picks")
    span = int(life.total_seconds() * 1000)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = {u: (p, t) for u, p, t in zip(*state.get, strict=True)} if state.exists else {}
        users, picks = {}, {}
        for frame in [] if state.hasTimedOut else frames:
            columns = ["user_id", "category", "product_id", "n", "at", "picks"]
            for user, category, product, n, micros, own in zip(*(frame[c].tolist() for c in columns), strict=True):
                counts, seen, newest = users.get(user) or ({}, set(), micros)
                if category is not None and not pd.isna(category):
                    counts[category] = counts.get(category, 0) + n
                    if category not in picks:
                        picks[category] = [int(p) for p in own] if own is not None else []
                if product is not None and not pd.isna(product):
                    seen.add(int(product))
                users[user] = (counts, seen, max(newest, micros))
        watermark = state.getCurrentWatermarkMs()
        held = {u: x for u, x in held.items() if u in users or x[1] + span >= watermark}
        found = []
        for user, (counts, seen, newest) in users.items():
            now = newest // 1000
            old, updated = held.pop(user, ([], now))
            products = next_list(popular, counts, picks, seen, old if now - updated <= span else [])
            found.append((user, products, newest))
            if now + span > watermark:
                held[user] = (products, now)
        if held:
            state.update((list(held), *map(list, zip(*held.values(), strict=True))))
            state.setTimeoutTimestamp(min(t for _, t in held.values()) + span)
        elif state.exists:
            state.remove()
        if found:
            out = pd.DataFrame(found, columns=["user_id", "product_ids", "updated_at"])
            yield out.assign(updated_at=pd.to_datetime(out["updated_at"], unit="us", utc=True))

    return rows.groupBy("bucket").applyInPandasWithState(
        update, LISTS, STATE, "update", GroupStateTimeout.EventTimeTimeout
    )
