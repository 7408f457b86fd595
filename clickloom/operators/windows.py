"""Per-user and global rankings, computed for all users at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import weights
from clickloom.functions.ranking import seeded_key, top_n_per_group
from clickloom.functions.times import AsOf, age_seconds, time_literal, trailing_window
from clickloom.operators.joins import (
    interactions_left_product,
    interactions_user_product,
    product_counts,
    products_left_recent,
)

NEWEST = ("ts", "interaction_id")

# Weight by age in seconds (upper bound, weight), else 1.
AGE_WEIGHTS = ((30, 10), (300, 8), (3600, 5), (86400, 2))

# History kind -> (event type, kept entries).
HISTORIES = {
    "recent_views": ("product_view", 50),
    "search_history": ("search", 100),
    "page_views": ("page_view", 200),
}
RECOMMENDATION_HISTORY = 50


def newest_first(*cols: str) -> list[Column]:
    return [F.desc(c) for c in (cols or NEWEST)]


def recent_per_user(
    interactions: DataFrame, products: DataFrame, as_of: AsOf, days: int = 7, n: int = 100
) -> DataFrame:
    """Latest ``n`` interactions per user in the window, with product columns.

    ``pos`` counts from 0 over all kept interactions, also those without a
    product: the cap comes before any filter on the category.
    """
    recent = trailing_window(interactions, as_of, days=days)
    capped = top_n_per_group(
        recent, ["user_id"], newest_first(), n, rank="pos", spread_by="interaction_id"
    ).withColumn("pos", F.col("pos") - 1)
    goods = products.select("product_id", "name", "category", "price")
    return interactions_left_product(capped, goods)


def latest_category(
    interactions: DataFrame,
    products: DataFrame,
    as_of: AsOf,
    minutes: int = 30,
    types: Sequence[str] = (*weights.CLICK_TYPES, *weights.VIEW_TYPES),
) -> DataFrame:
    """Category of each user's newest click or view; unknown categories are skipped."""
    recent = trailing_window(interactions, as_of, minutes=minutes).filter(
        F.col("interaction_type").isin(*types)
    )
    goods = products.filter(F.col("category").isNotNull()).select("product_id", "category")
    # Newest row per (user, product) first: a hot product is then one row per user.
    pairs = recent.groupBy("user_id", "product_id").agg(
        F.max(F.struct("ts", "interaction_id")).alias("seen")
    )
    return (
        pairs.join(goods, "product_id")
        .groupBy("user_id")
        .agg(F.max_by("category", "seen").alias("category"), F.max("seen")["ts"].alias("ts"))
    )


def bounded_history(events: DataFrame, kind: str, n: int | None = None) -> DataFrame:
    """Newest entries of one history kind per user, ranked from 1."""
    event_type, keep = HISTORIES[kind]
    data = lambda name: F.try_element_at("data", F.lit(name))
    columns = {
        "recent_views": [data("product_id").try_cast("long").alias("product_id")],
        "search_history": [
            data("query").alias("query"),
            F.coalesce(data("results_count").try_cast("long"), F.lit(0).cast("long")).alias(
                "results_count"
            ),
        ],
        "page_views": [data("page").alias("page")],
    }[kind]
    rows = events.filter(F.col("event_type") == event_type).select(
        "user_id", "event_id", "ts", *columns
    )
    return top_n_per_group(
        rows, ["user_id"], newest_first("ts", "event_id"), n or keep, spread_by="event_id"
    )


def bounded_recommendations(history: DataFrame, n: int = RECOMMENDATION_HISTORY) -> DataFrame:
    """Newest ``n`` past recommendations per user.

    ``history(user_id, product_id, category, ts, position)``; within one list a
    later position counts as newer.
    """
    rows = history.withColumn("_row", F.xxhash64("user_id", "ts", "position", "product_id"))
    order = newest_first("ts", "position", "product_id")
    return top_n_per_group(rows, ["user_id"], order, n, spread_by="_row").drop("_row")


def recency_points(recent: DataFrame, as_of: AsOf) -> DataFrame:
    """Family and tenth-points of each capped interaction.

    Points are base x age weight x position weight; the position weight falls
    from 10 by 0.1 per row to at least 1 and is kept in tenths, so the later sum
    is over whole numbers. Without a timestamp the age weight is 1.
    """
    age = age_seconds(recent, as_of)
    by_age = F.when(F.col("ts").isNull(), F.lit(1))
    for limit, weight in AGE_WEIGHTS:
        by_age = by_age.when(age <= limit, F.lit(weight))
    by_age = by_age.otherwise(F.lit(1))
    tenths = F.greatest(F.lit(100) - F.col("pos"), F.lit(10))
    kind = F.col("interaction_type")
    return recent.withColumns(
        {
            "family": weights.family_of(kind, weights.RECENCY),
            "tenths": weights.family_points(kind, weights.RECENCY) * by_age * tenths,
        }
    ).filter(F.col("family").isNotNull() & F.col("category").isNotNull())


def recency_weighted_scores(
    interactions: DataFrame, products: DataFrame, as_of: AsOf, days: int = 1, n: int = 100
) -> DataFrame:
    """Recency-weighted score per (user, family, category)."""
    recent = recent_per_user(interactions, products, as_of, days, n)
    return (
        recency_points(recent, as_of)
        .groupBy("user_id", "family", "category")
        .agg((F.sum("tenths") / 10).alias("score"))
    )


def top_category(scores: DataFrame, k: int = 1, score: str = "score") -> DataFrame:
    """Best ``k`` categories per user by score."""
    return top_n_per_group(
        scores, ["user_id"], [F.desc(score), F.asc("category")], k, spread_by="category"
    )


def top_products_in_category(
    products: DataFrame,
    n: int,
    mode: str = "newest_id",
    *,
    interactions: DataFrame | None = None,
    as_of: AsOf | None = None,
    days: int = 7,
    seed: str | int = 0,
) -> DataFrame:
    """First ``n`` products of each category.

    Modes: ``trend`` (interactions of the window, then newest), ``newest``,
    ``newest_id``, ``oldest_id`` and ``seeded`` (repeatable shuffle).
    """
    rows = products.filter(F.col("category").isNotNull())
    if mode == "trend":
        rows = products_left_recent(rows, interactions, as_of, days)
        order = [F.desc("interaction_count"), F.desc("created_at"), F.desc("product_id")]
    elif mode == "newest":
        order = [F.desc("created_at"), F.desc("product_id")]
    elif mode == "newest_id":
        order = [F.desc("product_id")]
    elif mode == "oldest_id":
        order = [F.asc("product_id")]
    elif mode == "seeded":
        rows = rows.withColumn("_key", seeded_key(F.col("product_id"), seed))
        order = [F.asc("_key"), F.asc("product_id")]
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return top_n_per_group(rows, ["category"], order, n, spread_by="product_id").drop("_key")


def global_trending(
    products: DataFrame,
    interactions: DataFrame,
    as_of: AsOf,
    n: int = 6,
    seed: str | int = 0,
    days: int = 3,
) -> DataFrame:
    """The ``n`` most used products of the last days; ties in seeded order."""
    counted = products_left_recent(products, interactions, as_of, days)
    return counted.orderBy(
        F.desc("interaction_count"), seeded_key(F.col("product_id"), seed), "product_id"
    ).limit(n)


def list_rank(lists: DataFrame, entries: str = "recommendations") -> DataFrame:
    """One row per list entry with its 1-based rank."""
    keys = [c for c in lists.columns if c != entries]
    return lists.select(*keys, F.posexplode(entries).alias("_pos", "entry")).select(
        *keys, (F.col("_pos") + 1).cast("int").alias("rank"), "entry.*"
    )


def recent_activity_feed(
    interactions: DataFrame, users: DataFrame, products: DataFrame, n: int = 20
) -> DataFrame:
    """Latest ``n`` interactions overall, with names; names join ``n`` rows only."""
    latest = interactions.orderBy(*newest_first()).limit(n)
    named = interactions_user_product(latest, users, products)
    return named.orderBy(*newest_first())


def first_products(products: DataFrame, n: int = 12) -> DataFrame:
    return products.orderBy("product_id").limit(n)


def user_history(
    interactions: DataFrame,
    products: DataFrame,
    as_of: AsOf,
    user_id: int | None = None,
    days: int | None = 1,
) -> DataFrame:
    """Interactions of one user (or of all) with product columns, newest first."""
    rows = interactions if days is None else trailing_window(interactions, as_of, days=days)
    if user_id is not None:
        rows = rows.filter(F.col("user_id") == user_id)
    goods = products.select("product_id", "name", "category", "price")
    return interactions_left_product(rows, goods).orderBy("user_id", *newest_first())


def window_feed(
    interactions: DataFrame,
    products: DataFrame,
    as_of: AsOf,
    hours: int = 24,
    n: int = 1000,
    min_rows: int = 0,
) -> DataFrame:
    """Newest ``n`` interactions of the window with product columns; empty unless
    the window holds more than ``min_rows`` rows."""
    rows = trailing_window(interactions, as_of, hours=hours)
    feed = rows.orderBy(*newest_first()).limit(n)
    if min_rows:
        enough = rows.agg((F.count("*") > min_rows).alias("enough"))
        feed = feed.filter(enough.scalar())
    goods = products.select("product_id", "name", "category", "price")
    return interactions_left_product(feed, goods).orderBy(*newest_first())


def event_positions(events: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """0-based position of each event in its user's time order.

    Rows are numbered inside (user, time bucket) and offset by the running count
    of the user's earlier buckets, so a user with a third of all events is
    numbered by many tasks and only the bucket counts meet in one.
    """
    rows = events.withColumn("_bucket", F.window("ts", bucket)["start"])
    inside = Window.partitionBy("user_id", "_bucket").orderBy("ts", "event_id")
    numbered = rows.withColumn("_inside", F.row_number().over(inside) - 1)
    sizes = rows.groupBy("user_id", "_bucket").agg(F.count("*").alias("_size"))
    earlier = (
        Window.partitionBy("user_id")
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.withColumn(
        "_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0).cast("long"))
    ).drop("_size")
    return (
        numbered.join(offsets, ["user_id", "_bucket"])
        .withColumn("position", F.col("_before") + F.col("_inside"))
        .drop("_bucket", "_inside", "_before")
    )


def user_event_lists(events: DataFrame, chunk: int = 500) -> DataFrame:
    """Aligned lists of event types and payloads per user, in time order.

    Lists come in chunks of at most ``chunk`` entries (``part`` 0, 1, ...), so
    nothing is dropped and no row holds an unbounded list.
    """
    part = F.floor(F.col("position") / chunk).cast("long")
    entry = F.struct("position", "event_type", "data")
    by_position = lambda x, y: (x["position"] - y["position"]).cast("int")
    lists = (
        event_positions(events)
        .groupBy("user_id", part.alias("part"))
        .agg(F.array_sort(F.collect_list(entry), by_position).alias("_events"))
    )
    return lists.select(
        "user_id",
        "part",
        F.col("_events.event_type").alias("event_types"),
        F.col("_events.data").alias("event_data"),
    )
