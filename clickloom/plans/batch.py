"""The recurring batch jobs, each a function of its tables and ``as_of``.

A run for the same ``as_of`` writes the same versions again, so a retry or a
scheduler's double start leaves one result. Scheduling is up to the caller.
"""

from __future__ import annotations

from datetime import timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.times import AsOf, time_literal, to_datetime, trailing_window
from clickloom.operators import aggregates, ml
from clickloom.sources import keyed, sinks


def version_of(as_of: AsOf) -> int:
    return int(to_datetime(as_of).replace(tzinfo=timezone.utc).timestamp())


def preference_ratings(interactions: DataFrame, products: DataFrame) -> DataFrame:
    """(user_id, product_id, rating): the preference score of each pair."""
    scores = aggregates.user_product_scores(interactions, products)
    return scores.select("user_id", "product_id", F.col("total_score").cast("float").alias("rating"))


def run_behaviour_batch(
    interactions: DataFrame,
    products: DataFrame,
    root: str,
    as_of: AsOf,
    days: int = 30,
    n: int = 10,
    als_blocks: int | None = None,
) -> None:
    """Preferences, ALS lists, trending products and rule segments, published."""
    version = version_of(as_of)
    spark = interactions.sparkSession

    def publish(df: DataFrame, name: str, keys: list[str]) -> None:
        path = f"{root}/{name}"
        keyed.publish_keyed(df, path, keys, keyed.TTL[name], as_of, version)
        keyed.compact(spark, path, keys, as_of)

    recent = trailing_window(interactions, as_of, days=days).select(
        "user_id", "product_id", "interaction_type", "ts"
    )
    # counts per user, product and type give all results but the trend of the last days
    reduced = recent.groupBy("user_id", "product_id", "interaction_type").agg(F.count("*").alias("n"))
    reduced = reduced.persist(StorageLevel.MEMORY_AND_DISK)
    publish(aggregates.category_preferences(reduced, products), "user_preferences", ["user_id", "category"])
    publish(aggregates.trending_products(recent, products, as_of), "trending_products", ["product_id"])
    publish(
        aggregates.user_segments_rule(reduced, products).select("user_id", "segment"),
        "user_segment",
        ["user_id"],
    )
    ratings, labels = ml.model_ids(preference_ratings(reduced, products))
    ratings = ratings.persist(StorageLevel.MEMORY_AND_DISK)
    model = ml.train_als(ml.split_ratings(ratings).train, blocks=als_blocks)
    lists = ml.recommend_for_all(model, labels, str(as_of), n)
    publish(
        lists.select("user_id", F.col("recommendations.product_id").cast("array<bigint>").alias("product_ids")),
        "recommendations",
        ["user_id"],
    )
    ratings.unpersist()
    reduced.unpersist()


def run_segmentation(
    interactions: DataFrame, products: DataFrame, root: str, as_of: AsOf
) -> DataFrame:
    """User features, K-Means clusters, their profile and labelled insights."""
    features = aggregates.user_features(interactions, products, as_of, ordered=False)
    features = features.persist(StorageLevel.MEMORY_AND_DISK)
    scaled, _ = ml.assemble_scale(features)
    model, _ = ml.kmeans_select_k(scaled)
    assigned = model.transform(scaled)
    sinks.write_snapshot(
        assigned.drop("features_raw", "features"), f"{root}/user_segments"
    )
    insights = ml.label_clusters(ml.cluster_profile(assigned))
    sinks.write_json(insights, f"{root}/cluster_insights")
    features.unpersist()
    return features.sparkSession.read.json(f"{root}/cluster_insights")


def run_collaborative(
    interactions: DataFrame,
    root: str,
    as_of: AsOf,
    n: int = 10,
    grid=ml.ALS_GRID,
    als_blocks: int | None = None,
) -> DataFrame:
    """Implicit ratings up to ``as_of``, tuned ALS, its metrics, stored model and lists."""
    past = interactions.where(F.col("ts") <= time_literal(interactions, "ts", as_of))
    ratings, labels = ml.model_ids(aggregates.implicit_ratings(past))
    ratings = ratings.persist(StorageLevel.MEMORY_AND_DISK)
    parts = ml.split_ratings(ratings, validation=0.16, test=0.2)
    model, _, _ = ml.tune_als(parts.train, parts.validation, grid, als_blocks)
    sinks.save_model(model, f"{root}/als_model")
    sinks.write_json(
        ml.cf_performance(parts.test, model.transform(parts.test)), f"{root}/cf_performance"
    )
    sinks.write_json(
        ml.recommend_for_all(model, labels, str(as_of), n), f"{root}/collaborative_filtering"
    )
    ratings.unpersist()
    return ratings.sparkSession.read.json(f"{root}/cf_performance")
