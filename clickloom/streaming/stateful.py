"""Incremental twins of the batch aggregates, and their batch counterparts.

State is bounded by a watermark (dedup, timeline, gap sessions, engagement) or
by the number of keys (counters).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import scalars, weights
from clickloom.operators import aggregates
from clickloom.operators.projections import normalise_event_type


def event_time(events: DataFrame) -> DataFrame:
    """Event time as TIMESTAMP, the type watermarks need."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def dedup_events(
    events: DataFrame, delay: str = "10 minutes", by_content: bool = False, seconds: int = 2
) -> DataFrame:
    """Drop repeated deliveries.

    By event id, inside the watermark delay. ``by_content`` drops double
    tracking instead: events of one user and tab with the same normalised type
    and the same product, query, page and category, each at most ``seconds``
    after the one before; the first of such a run stays (by time, then id).
    Later repeats are events of their own. Without a watermark column (a batch)
    the whole table is one run of the stream.
    """
    marked = event_time(events).withWatermark("ts", delay)
    if not by_content:
        return marked.dropDuplicatesWithinWatermark(["event_id"])
    data = lambda name: F.try_element_at("data", F.lit(name))
    named = normalise_event_type(marked).withColumns(
        {
            "_product": scalars.product_id_of(F.col("data")),
            "_query": data("query"),
            "_page": data("page"),
            "_category": data("category"),
        }
    )
    columns = [*events.columns, "normalised_type"]
    same = [c for c in ("user_id", "session_id") if c in events.columns]
    run = F.session_window("ts", f"{int(seconds)} seconds")
    # runs that a nameless user shares are told apart by the event id
    nameless = F.when(F.coalesce(*same).isNull(), F.col("event_id"))
    first = F.min_by(F.struct(*columns), F.struct("ts", "event_id"))
    kept = named.groupBy(run, *same, nameless.alias("_alone"), "normalised_type", "_product", "_query", "_page", "_category")
    return kept.agg(first.alias("_first")).select("_first.*")


def product_actions(events: DataFrame) -> DataFrame:
    """(product_id, action, time) of the events that count for a product."""
    kind = F.coalesce(F.try_element_at("data", F.lit("event_type")), F.col("event_type"))
    action = F.try_element_at("data", F.lit("action"))
    product = F.try_element_at("data", F.lit("product_id")).try_cast("long")
    name = F.when(kind == "product_view", F.lit("view")).when(
        (kind == "click") & (action != ""), action
    )
    return events.select(product.alias("product_id"), name.alias("action"), "ts").filter(
        F.col("product_id").isNotNull() & F.col("action").isNotNull()
    )


def stream_product_counters(events: DataFrame) -> DataFrame:
    """Running count per (product, action) with its newest time; for update mode."""
    return product_actions(events).groupBy("product_id", "action").agg(
        F.count("*").alias("count"), F.max("ts").alias("last_ts")
    )


def stream_profile_counters(events: DataFrame) -> DataFrame:
    """Running category and price-band counts per user with their newest time; for update mode."""
    return aggregates.profile_entries(events).groupBy("user_id", "kind", "value").agg(
        F.count("*").alias("count"), F.max("ts").alias("last_ts")
    )


def stream_timeline(
    interactions: DataFrame, width: str = "1 minute", delay: str = "10 minutes"
) -> DataFrame:
    """Clicks, views and purchases per tumbling window."""
    kind = F.col("interaction_type")
    return (
        event_time(interactions)
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", width))
        .agg(
            F.count_if(kind.isin(*weights.CLICK_TYPES)).alias("clicks"),
            F.count_if(kind.isin(*weights.VIEW_TYPES)).alias("views"),
            F.count_if(kind == "purchase").alias("purchases"),
        )
        .select(F.col("window.start").alias("bucket"), "clicks", "views", "purchases")
    )


def stream_timeline_levels(
    interactions: DataFrame, fine: str = "1 minute", coarse: str = "1 hour", delay: str = "10 minutes"
) -> DataFrame:
    """The timeline per ``coarse`` window from closed ``fine`` windows, in one stream; for append mode.

    The events are counted once; the second aggregate adds up the rows of the
    first by the time of their windows. ``fine_windows`` counts those with
    events, ``busiest`` is the largest number of clicks, views and purchases in one.
    """
    kind = F.col("interaction_type")
    marked = event_time(interactions).withWatermark("ts", delay)
    small = marked.groupBy(F.window("ts", fine)).agg(
        F.count_if(kind.isin(*weights.CLICK_TYPES)).alias("clicks"),
        F.count_if(kind.isin(*weights.VIEW_TYPES)).alias("views"),
        F.count_if(kind == "purchase").alias("purchases"),
    )
    large = small.groupBy(F.window(F.window_time("window"), coarse).alias("wide")).agg(
        *(F.sum(c).alias(c) for c in ("clicks", "views", "purchases")),
        F.count("*").alias("fine_windows"),
        F.max(F.col("clicks") + F.col("views") + F.col("purchases")).alias("busiest"),
    )
    return large.select(F.col("wide.start").alias("bucket"), "clicks", "views", "purchases", "fine_windows", "busiest")


def stream_user_minutes(interactions: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """The users of each closed minute as bitmaps, ``minute_end, part, users``; for append mode.

    A bitmap holds the 32,768 ids of its ``part``, so a minute's state is
    bounded by the ids and not by the events. Rows without a user say nothing.
    ``dashboards.live_users`` merges the minutes.
    """
    known = event_time(interactions).withWatermark("ts", delay).filter(F.col("user_id").isNotNull())
    user = F.col("user_id").cast("bigint")
    minutes = known.groupBy(F.window("ts", "1 minute"), F.bitmap_bucket_number(user).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("users")
    )
    return minutes.select(F.col("window.end").alias("minute_end"), "part", "users")


def session_activity(heartbeats: DataFrame) -> DataFrame:
    """Latest state per session: last activity, and the user of that moment."""
    last = F.max(F.struct("ts", "event_id", "user_id"))
    return (
        heartbeats.filter(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(last.alias("_last"), F.min("ts").alias("created_at"))
        .select(
            "session_id",
            F.col("_last.user_id").alias("user_id"),
            F.col("_last.ts").alias("last_activity"),
            "created_at",
        )
    )


def gap_sessions(events: DataFrame, gap_minutes: int = 5) -> DataFrame:
    """Sessions of each user: a pause longer than the gap starts a new one.

    Events are reduced to one piece per (user, minute) first. Events inside a
    minute are never a gap apart, so the result is exact, and a very active user
    costs the ranking one row per minute instead of one per event.
    """
    minute = F.window("ts", "1 minute")["start"]
    pieces = events.groupBy("user_id", minute.alias("_m")).agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("n")
    )
    in_order = Window.partitionBy("user_id").orderBy("_m")
    gap = F.expr(f"INTERVAL {int(gap_minutes)} MINUTES")
    starts = F.coalesce(F.col("first") > F.lag("last").over(in_order) + gap, F.lit(True))
    numbered = pieces.withColumn("_new", starts.cast("int")).withColumn(
        "session_no", F.sum("_new").over(in_order)
    )
    return numbered.groupBy("user_id", "session_no").agg(
        F.min("first").alias("session_start"),
        F.max("last").alias("session_end"),
        F.sum("n").alias("event_count"),
    )


def stream_gap_sessions(
    events: DataFrame, gap: str = "5 minutes", delay: str = "10 minutes"
) -> DataFrame:
    """Sessions of each user as an event-time session window; for append mode."""
    return (
        event_time(events)
        .withWatermark("ts", delay)
        .groupBy(F.session_window("ts", gap).alias("w"), "user_id")
        .agg(F.count("*").alias("event_count"), F.max("ts").alias("session_end"))
        .select("user_id", F.col("w.start").alias("session_start"), "session_end", "event_count")
    )


def _number(name: str) -> Column:
    return F.try_element_at("data", F.lit(name)).try_cast("double")


def engagement_events(events: DataFrame) -> DataFrame:
    """Deepest scroll, time spent and average load time per (user, page)."""
    kind = F.col("event_type")
    rows = events.filter(kind.isin("page_load", "scroll_depth", "page_blur", "page_unload"))
    return rows.groupBy("user_id", F.try_element_at("data", F.lit("page")).alias("page")).agg(
        F.max(F.when(kind == "scroll_depth", _number("depth"))).alias("max_depth"),
        F.sum(F.when(kind.isin("page_blur", "page_unload"), _number("time_spent"))).alias(
            "time_spent"
        ),
        F.avg(F.when(kind == "page_load", _number("load_time"))).alias("avg_load_time"),
    )
