"""Dashboard aggregates: live metrics, timelines and headline numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import weights
from clickloom.functions.ranking import best_key
from clickloom.functions.scalars import exact_money, ratio
from clickloom.functions.times import (
    AsOf,
    bucket_start,
    time_literal,
    to_datetime,
    trailing_window,
)
from clickloom.operators.joins import product_counts, with_scalar_total


# Volume bands (least interactions, label).
VOLUME_BANDS = (
    (50, "Heavy Buyers"),
    (20, "Category Focused"),
    (10, "Window Shoppers"),
    (5, "Seasonal Buyers"),
)
VOLUME_OTHER = "New Users"


def top_products_stats(
    products: DataFrame, interactions: DataFrame, as_of: AsOf, days: int = 7, n: int = 20
) -> DataFrame:
    """Interactions, users, clicks and views of the ``n`` busiest products.

    The window is applied after the left join: a product whose interactions are
    all older than the window is not listed, a product never used is.
    """
    now = time_literal(interactions, "ts", as_of)
    since = now - F.expr(f"INTERVAL {int(days)} DAYS")
    recent = F.col("ts") >= since
    kind = F.col("interaction_type")
    used = (
        interactions.filter(F.col("product_id").isNotNull() & (F.col("ts") <= now))
        .groupBy("product_id")
        .agg(
            F.count_if(recent).alias("interaction_count"),
            F.count_distinct(F.when(recent, F.col("user_id"))).alias("unique_users"),
            F.count_if(recent & (kind == "click")).alias("clicks"),
            F.count_if(recent & (kind == "view")).alias("views"),
        )
    )
    numbers = ["interaction_count", "unique_users", "clicks", "views"]
    joined = products.select("product_id", "name", "category", "price").join(
        used, "product_id", "left"
    )
    kept = joined.filter(
        F.col("interaction_count").isNull() | (F.col("interaction_count") > 0)
    )
    return (
        kept.fillna(0, subset=numbers)
        .orderBy(F.desc("interaction_count"), "product_id")
        .limit(n)
    )


def _activity(rows: DataFrame, width: str, n: int) -> DataFrame:
    kind = F.col("interaction_type")
    return (
        rows.groupBy(bucket_start("ts", width).alias("bucket"))
        .agg(
            F.count_if(kind.isin(*weights.CLICK_TYPES)).alias("clicks"),
            F.count_if(kind.isin(*weights.VIEW_TYPES)).alias("views"),
            F.count_if(kind == "purchase").alias("purchases"),
        )
        .orderBy(F.desc("bucket"))
        .limit(n)
    )


def activity_timeline(
    interactions: DataFrame, as_of: AsOf, hours: int = 2, n: int = 24
) -> DataFrame:
    """Newest ``n`` minutes with activity in the last hours; when there are none,
    the newest ``n`` hours of all data.

    Both are at most ``n`` rows; a count of the recent ones decides, when the
    query runs, which of them stay.
    """
    recent = _activity(trailing_window(interactions, as_of, hours=hours), "1 minute", n)
    now = time_literal(interactions, "ts", as_of)
    whole = _activity(interactions.filter(F.col("ts") <= now), "1 hour", n)
    found = recent.agg(F.count("*").alias("n")).scalar()
    return recent.unionByName(whole.where(found == 0)).orderBy(F.desc("bucket"))


def latest_bucket(timeline: DataFrame) -> DataFrame:
    """Activity of the newest bucket of a timeline."""
    newest = F.max_by(F.struct("clicks", "views", "purchases"), F.col("bucket"))
    return timeline.agg(F.max("bucket").alias("bucket"), newest.alias("last")).select(
        "bucket", "last.*"
    )


def category_performance(
    products: DataFrame, interactions: DataFrame, users: DataFrame
) -> DataFrame:
    """Interactions, their price value, average price and user reach per category.

    Reduced to one row per (product, user) before the join; products without
    interactions still count as one row of their price.
    """
    pairs = (
        interactions.filter(F.col("product_id").isNotNull())
        .groupBy("product_id", "user_id")
        .agg(F.count("*").alias("n"))
    )
    goods = products.filter(F.col("category").isNotNull()).select(
        "product_id", "category", exact_money(F.col("price")).alias("price")
    )
    used = goods.join(pairs, "product_id")
    idle = goods.join(pairs.select("product_id").distinct(), "product_id", "left_anti")
    rows = used.unionByName(idle, allowMissingColumns=True)
    weight = F.coalesce("n", F.lit(1).cast("long"))
    stats = rows.groupBy("category").agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("interaction_count"),
        F.sum(F.col("price") * weight).alias("_value"),
        F.sum(F.when(F.col("price").isNotNull(), weight)).alias("_rows"),
        F.count_distinct("user_id").alias("_users"),
    )
    return (
        with_scalar_total(stats, users, "_all")
        .select(
            "category",
            "interaction_count",
            F.col("_value").cast("double").alias("interaction_value"),
            ratio(F.col("_value"), F.col("_rows")).alias("avg_price"),
            ratio(F.col("_users"), F.col("_all")).alias("user_engagement"),
        )
        .orderBy(F.desc("interaction_count"), "category")
    )


def volume_band(count: Column) -> Column:
    out = F.lit(VOLUME_OTHER)
    for least, label in reversed(VOLUME_BANDS):
        out = F.when(count >= least, F.lit(label)).otherwise(out)
    return out


def volume_segments(interactions: DataFrame, spend: int = 100_000) -> DataFrame:
    """Users, average spend and average volume per volume band."""
    bought = F.when(F.col("interaction_type") == "purchase", F.lit(spend)).otherwise(F.lit(0))
    per_user = interactions.groupBy("user_id").agg(
        F.count("*").alias("n"), F.sum(bought.cast("long")).alias("spent")
    )
    return (
        per_user.groupBy(volume_band(F.col("n")).alias("segment"))
        .agg(
            F.count("*").alias("user_count"),
            F.sum("spent").alias("_spent"),
            F.sum("n").alias("_n"),
        )
        .select(
            "segment",
            "user_count",
            ratio(F.col("_spent"), F.col("user_count")).alias("avg_spending"),
            ratio(F.col("_n"), F.col("user_count")).alias("avg_interactions"),
        )
        .orderBy(F.desc("avg_interactions"))
    )


def live_metrics(interactions: DataFrame, as_of: AsOf) -> DataFrame:
    """Last hour's users, users of the last five minutes, volume and rates."""
    rows = trailing_window(interactions, as_of, hours=1)
    since = time_literal(interactions, "ts", to_datetime(as_of)) - F.expr("INTERVAL 5 MINUTES")
    active = F.when(F.col("ts") >= since, F.col("user_id"))
    stats = rows.agg(
        F.count_distinct("user_id").alias("total_users"),
        F.count_distinct(active).alias("active_users"),
        F.count("*").alias("total_interactions"),
    )
    return stats.withColumns(
        {
            "per_second": F.floor(F.col("total_interactions") / 3600).cast("long"),
            "per_minute": F.floor(F.col("total_interactions") / 60).cast("long"),
        }
    )


def _wider(spans: DataFrame, minutes: int) -> DataFrame:
    """Bitmaps of each span joined with those of the span that ends ``minutes`` before."""
    ends = F.array(F.col("minute_end"), F.col("minute_end") + F.expr(f"INTERVAL {minutes} MINUTES"))
    rows = spans.select(F.explode(ends).alias("minute_end"), "part", "users")
    return rows.groupBy("minute_end", "part").agg(F.bitmap_or_agg("users").alias("users"))


def live_users(minutes: DataFrame, as_of: AsOf, hours: int = 24) -> DataFrame:
    """Distinct users of the hour and of the five minutes before each minute's end.

    ``minutes`` are the bitmaps of ``stream_user_minutes``. Spans double from
    one minute to 32; two spans that overlap give the 60, since a user counts
    once however often a bit is set. So a bitmap is merged seven times, not
    once for each of 60 minutes. The ends lie in the ``hours`` up to ``as_of``;
    one whose hour has no user has no row.
    """
    end, until = F.col("minute_end"), time_literal(minutes, "minute_end", to_datetime(as_of))
    since = until - F.expr(f"INTERVAL {int(hours)} HOURS")
    four = _wider(_wider(minutes.filter((end > since - F.expr("INTERVAL 1 HOUR")) & (end <= until)), 1), 2)
    hour = _wider(_wider(_wider(_wider(four, 4), 8), 16), 28)

    def users(spans: DataFrame, name: str) -> DataFrame:
        inside = spans.filter((end > since) & (end <= until))
        return inside.groupBy("minute_end").agg(F.sum(F.bitmap_count("users")).alias(name))

    both = users(hour, "total_users").join(users(_wider(four, 1), "active_users"), "minute_end", "left")
    return both.withColumn("active_users", F.coalesce("active_users", F.lit(0).cast("bigint")))


def active_sessions(sessions: DataFrame, as_of: AsOf, minutes: int = 5) -> DataFrame:
    """Sessions seen in the last minutes, newest first."""
    rows = trailing_window(sessions, as_of, ts="last_activity", minutes=minutes)
    return rows.select("session_id", "user_id", "last_activity").orderBy(
        F.desc("last_activity"), "session_id"
    )


def active_session_count(sessions: DataFrame, as_of: AsOf, minutes: int = 5) -> DataFrame:
    rows = trailing_window(sessions, as_of, ts="last_activity", minutes=minutes)
    return rows.agg(F.count("*").alias("active_sessions"))


def active_sessions_by_user(sessions: DataFrame, as_of: AsOf, minutes: int = 5) -> DataFrame:
    """Active sessions per user; visitors who are not logged in are user 0."""
    rows = trailing_window(sessions, as_of, ts="last_activity", minutes=minutes)
    user = F.coalesce("user_id", F.lit(0).cast("long"))
    return rows.groupBy(user.alias("user_id")).agg(F.count("*").alias("session_count"))


def hourly_by_type(interactions: DataFrame) -> DataFrame:
    """Interactions per hour of day and type."""
    return interactions.groupBy(F.hour("ts").alias("hour"), "interaction_type").agg(
        F.count("*").alias("interaction_count")
    )


def interactions_per_category(interactions: DataFrame, products: DataFrame) -> DataFrame:
    goods = products.filter(F.col("category").isNotNull()).select("product_id", "category")
    return (
        product_counts(interactions)
        .join(goods, "product_id")
        .groupBy("category")
        .agg(F.sum("interaction_count").alias("interaction_count"))
    )


def top_categories(interactions: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    return (
        interactions_per_category(interactions, products)
        .orderBy(F.desc("interaction_count"), "category")
        .limit(n)
    )


def headline_stats(
    interactions: DataFrame, products: DataFrame, as_of: AsOf, hours: int = 24
) -> DataFrame:
    """Last hour's interactions, users of the feed and its most common category."""
    feed = trailing_window(interactions, as_of, hours=hours)
    last_hour = F.col("ts") >= time_literal(interactions, "ts", to_datetime(as_of)) - F.expr(
        "INTERVAL 1 HOUR"
    )
    popular = interactions_per_category(feed, products).agg(
        best_key(F.col("interaction_count"), F.col("category")).alias("c")
    )
    return feed.agg(
        F.count_if(last_hour).alias("recent_interactions"),
        F.count_distinct("user_id").alias("active_users"),
    ).withColumn("popular_category", popular.scalar())


def table_totals(
    interactions: DataFrame, products: DataFrame, users: DataFrame, as_of: AsOf
) -> DataFrame:
    """Row counts of the tables, recent interactions and the first event time."""
    since = time_literal(interactions, "ts", to_datetime(as_of)) - F.expr("INTERVAL 30 MINUTES")
    now = time_literal(interactions, "ts", as_of)
    base = interactions.agg(
        F.count("*").alias("interactions"),
        F.count_if((F.col("ts") >= since) & (F.col("ts") <= now)).alias("recent_interactions"),
        F.min("ts").alias("first_event"),
    )
    return with_scalar_total(with_scalar_total(base, products, "products"), users, "users")
