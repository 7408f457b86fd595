"""Set and ordered-list operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.ranking import top_n_per_group
from clickloom.functions.times import AsOf, time_literal, to_datetime
from clickloom.operators.joins import exclude_ids

# Sizes of the streaming candidate lists.
TRENDING_CANDIDATES = 5
PER_CATEGORY_CANDIDATES = 3
MAX_CANDIDATES = 10
MAX_LIST = 15


def merge_ranked(new: Column, current: Column, n: int = MAX_LIST) -> Column:
    """New entries before current ones, first occurrence kept, first ``n``."""
    empty = F.array().cast("array<bigint>")
    both = F.concat(F.coalesce(new, empty), F.coalesce(current, empty))
    return F.slice(F.array_distinct(both), 1, n)


def candidate_union(
    users: DataFrame,
    interests: DataFrame,
    recent: DataFrame,
    trending: DataFrame,
    category_top: DataFrame,
    n: int = MAX_CANDIDATES,
) -> DataFrame:
    """Ranked candidate products per user.

    The best trending products come first, then the best products of each
    category of interest (strongest interest first); products the user has just
    seen are left out. ``interests(user_id, category, count)``,
    ``recent(user_id, product_id)``, ``trending(product_id, rank)`` and
    ``category_top(category, product_id, rank)``.
    """
    popular = trending.filter(F.col("rank") <= TRENDING_CANDIDATES).agg(
        F.array_sort(F.collect_list(F.struct("rank", "product_id"))).alias("p")
    )
    # Order keys sort the trending block before the category block.
    from_trending = users.select(
        "user_id", F.inline(popular.scalar())
    ).select(
        "user_id",
        "product_id",
        F.struct(
            F.lit(0).alias("block"),
            F.lit(0).cast("long").alias("weight"),
            F.lit("").alias("category"),
            F.col("rank").alias("rank"),
        ).alias("ord"),
    )
    best = category_top.filter(F.col("rank") <= PER_CATEGORY_CANDIDATES)
    from_category = interests.join(best, "category").select(
        "user_id",
        "product_id",
        F.struct(
            F.lit(1).alias("block"),
            (-F.col("count")).alias("weight"),
            F.col("category").alias("category"),
            F.col("rank").alias("rank"),
        ).alias("ord"),
    )
    candidates = (
        from_trending.unionByName(from_category)
        .groupBy("user_id", "product_id")
        .agg(F.min("ord").alias("ord"))
    )
    unseen = exclude_ids(candidates, recent, ["user_id", "product_id"])
    return top_n_per_group(
        unseen, ["user_id"], [F.asc("ord"), F.asc("product_id")], n, spread_by="product_id"
    ).select("user_id", "product_id", "rank")


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct non-NULL values of the columns."""
    rows = df.select(*columns)
    for name in columns:
        rows = rows.filter(F.col(name).isNotNull())
    return rows.distinct()


def drop_matching_sessions(
    sessions: DataFrame,
    prefix: str | None = None,
    as_of: AsOf | None = None,
    minutes: int = 5,
) -> DataFrame:
    """Sessions left after removing an id prefix and those idle for longer."""
    out = sessions
    if prefix:
        out = out.filter(~F.col("session_id").startswith(prefix))
    if as_of is not None:
        since = time_literal(sessions, "last_activity", to_datetime(as_of)) - F.expr(
            f"INTERVAL {int(minutes)} MINUTES"
        )
        out = out.filter(F.col("last_activity") >= since)
    return out
