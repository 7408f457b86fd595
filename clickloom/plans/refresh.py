"""Refresh of the stored lists from one batch of events, for all its users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators import aggregates, lists, projections, windows


def category_top(products: DataFrame, interactions: DataFrame, as_of) -> DataFrame:
    """Best products per category, the list a refresh draws its candidates from."""
    return windows.top_products_in_category(
        products,
        lists.PER_CATEGORY_CANDIDATES,
        "trend",
        interactions=interactions,
        as_of=as_of,
    ).select("category", "product_id", "rank")


def trending_ranks(trending: DataFrame) -> DataFrame:
    """(product_id, rank) of the best trending products, by their score."""
    best = (
        trending.orderBy(F.desc("trending_score"), "product_id")
        .limit(lists.TRENDING_CANDIDATES)
        .agg(
            F.array_sort(
                F.collect_list(F.struct((-F.col("trending_score")).alias("w"), "product_id"))
            ).alias("t")
        )
    )
    return best.select(F.posexplode("t").alias("_pos", "e")).select(
        "e.product_id", (F.col("_pos") + 1).cast("int").alias("rank")
    )


def refresh_recommendations(
    events: DataFrame, stored: DataFrame, trending: DataFrame, shelf: DataFrame
) -> DataFrame:
    """New list per user of the batch: fresh candidates before the stored list.

    ``stored(user_id, product_ids)``, ``trending(product_id, rank)`` and
    ``shelf(category, product_id, rank)``.
    """
    important = projections.important_events(events)
    users = important.select("user_id").filter(F.col("user_id").isNotNull()).distinct()
    interests = aggregates.user_interests(important)
    categories = interests.filter(F.col("kind") == "category").select(
        "user_id", F.col("value").alias("category"), "count"
    )
    recent = interests.filter(F.col("kind") == "recent_product").select(
        "user_id", F.col("value").cast("long").alias("product_id")
    )
    ranked = lists.candidate_union(users, categories, recent, trending, shelf)
    fresh = ranked.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "product_id")))["product_id"].alias("_new")
    )
    joined = users.join(fresh, "user_id", "left").join(
        stored.select("user_id", F.col("product_ids").alias("_old")), "user_id", "left"
    )
    return joined.select(
        "user_id", lists.merge_ranked(F.col("_new"), F.col("_old")).alias("product_ids")
    )
