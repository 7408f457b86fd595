"""Per-user profiles behind the recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators import projections

TOP = 3


def _ranked(entries: Column) -> Column:
    """Category entries by score, then name; an entry is (-score, category)."""
    return F.transform(
        F.array_sort(entries),
        lambda e: F.struct(e["c"].alias("category"), (-e["w"]).alias("score")),
    )


def _entries(score: str) -> Column:
    """Per category entries of a positive score; bounded by the history cap."""
    return F.collect_list(
        F.when(
            F.col(score) > 0,
            F.struct((-F.col(score)).alias("w"), F.col("category").alias("c")),
        )
    )


def explain_recommendations(lists: DataFrame, recent: DataFrame) -> DataFrame:
    """Strategy, behaviour counts, strongest categories and reasons per user.

    ``recent`` is the capped history the lists were made from.
    """
    kept = projections.with_simple_family(recent).filter(F.col("category").isNotNull())
    clicked = F.col("family") == "clicked"
    zero = F.lit(0).cast("long")
    per_category = kept.groupBy("user_id", "category").agg(
        F.sum(F.when(clicked, F.col("score")).otherwise(zero)).alias("clicked"),
        F.sum(F.when(clicked, zero).otherwise(F.col("score"))).alias("viewed"),
        F.count_if(clicked).alias("clicks"),
        F.count("*").alias("rows"),
        F.min(F.struct("pos", "category")).alias("latest"),
        F.min(F.when(clicked, F.struct("pos", "category", "name"))).alias("latest_click"),
    )
    profile = per_category.groupBy("user_id").agg(
        F.sum("clicks").alias("recent_clicks_count"),
        F.sum("rows").alias("recent_interactions_count"),
        F.slice(_ranked(_entries("clicked")), 1, TOP).alias("top_clicked_categories"),
        F.slice(_ranked(_entries("viewed")), 1, TOP).alias("top_viewed_categories"),
        F.sum(F.col("clicked") + F.col("viewed")).alias("total_interactions"),
        F.min("latest_click").alias("_click"),
        F.min("latest")["category"].alias("latest_interaction_category"),
    )
    return (
        lists.select(
            "user_id",
            "strategy_used",
            F.size("recommendations").alias("total"),
            F.col("recommendations.reason").alias("recommendation_reasons"),
        )
        .join(profile, "user_id", "left")
        .withColumn("latest_click_category", F.col("_click.category"))
        .withColumn("latest_click_product", F.col("_click.name"))
        .drop("_click")
        .fillna(0, ["recent_clicks_count", "recent_interactions_count", "total_interactions"])
    )


def behaviour_profile(recent: DataFrame, favourites: int = 5) -> DataFrame:
    """Category scores per family, click and view counts and favourite products.

    ``recent`` is capped per user, so every list is bounded by that cap.
    """
    scored = projections.with_cascade_family(recent).filter(
        F.col("category").isNotNull() & F.col("family").isNotNull()
    )
    kind = F.col("interaction_type")
    family = F.col("family")
    view = kind.isin("view", "product_view")
    zero = F.lit(0).cast("long")
    of = lambda f: F.sum(F.when(family == f, F.col("score")).otherwise(zero))
    # Reduced per product first; favourites and category scores follow from it.
    pairs = scored.groupBy("user_id", "category", "product_id").agg(
        of("clicked").alias("clicked"),
        of("viewed").alias("viewed"),
        of("searched").alias("searched"),
        F.count_if(family == "clicked").alias("clicks"),
        F.count_if(view).alias("views"),
    )
    per_category = pairs.groupBy("user_id", "category").agg(
        F.sum("clicked").alias("clicked"),
        F.sum("viewed").alias("viewed"),
        F.sum("searched").alias("searched"),
        F.sum("clicks").alias("clicks"),
        F.sum("views").alias("views"),
        F.collect_list(
            F.when(
                F.col("views") > 0,
                F.struct((-F.col("views")).alias("w"), F.col("product_id").alias("p")),
            )
        ).alias("liked"),
    )
    liked = F.array_sort(F.flatten(F.collect_list("liked")))
    return per_category.groupBy("user_id").agg(
        _ranked(_entries("clicked")).alias("clicked_categories"),
        _ranked(_entries("viewed")).alias("viewed_categories"),
        _ranked(_entries("searched")).alias("searched_categories"),
        F.sum("clicks").alias("recent_clicks_count"),
        F.sum("views").alias("recent_views_count"),
        F.slice(liked["p"], 1, favourites).alias("favorite_products"),
    )
