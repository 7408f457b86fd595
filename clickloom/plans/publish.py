"""Storing the lists of a recommender: ids, details and what users were offered."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.times import AsOf, to_datetime
from clickloom.operators import windows
from clickloom.plans.batch import version_of
from clickloom.sources import keyed

KEYS = ["user_id"]


def run_recommendations(lists: DataFrame, products: DataFrame, root: str, as_of: AsOf, name: str) -> None:
    """Publish ``lists(user_id, strategy_used, recommendations)`` of the recommender ``name``.

    Ids live three days under ``recommendations``, the entries with their
    reasons one hour under ``recommendation_details``; the newest fifty offers
    of a user stay under ``offers``. A run for the same ``as_of`` replaces its
    own results.
    """
    version, spark = version_of(as_of), lists.sparkSession
    lists = lists.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ids = lists.select("user_id", F.col("recommendations.product_id").cast("array<bigint>").alias("product_ids"))
        keyed.publish_keyed(
            ids, f"{root}/recommendations", KEYS, keyed.TTL["recommendations"], as_of, version, name
        )
        keyed.publish_keyed(
            lists, f"{root}/recommendation_details", KEYS, keyed.TTL["recommendation_details"], as_of, version, name
        )
        offers = lists.select("user_id", F.posexplode("recommendations").alias("position", "e"))
        offers = offers.select("user_id", F.col("e.product_id").alias("product_id"), F.col("position").cast("long"))
        offers = offers.join(products.select("product_id", "category"), "product_id")
        stamp = F.lit(to_datetime(as_of).isoformat(sep=" ")).cast("timestamp_ntz")
        keyed.publish_version(offers.withColumn("ts", stamp), f"{root}/offers", KEYS, version, name)
        keyed.compact(spark, f"{root}/recommendations", KEYS, as_of)
        keyed.compact(spark, f"{root}/recommendation_details", KEYS, as_of)
        keyed.compact_versions(spark, f"{root}/offers", KEYS, _fold)
    finally:
        lists.unpersist()


def _fold(rows: DataFrame) -> DataFrame:
    marks = {"_writer": F.lit(keyed.BASE), "_version": F.lit(0).cast("long")}
    return windows.bounded_recommendations(rows.drop("_late", *marks)).drop("rank").withColumns(marks)


def past_recommendations(spark: SparkSession, root: str) -> DataFrame:
    """The newest fifty offers per user, the history of the recency recommender."""
    rows = keyed.history(spark, f"{root}/offers")
    if rows is None:
        kind = "user_id bigint, product_id bigint, category string, ts timestamp_ntz, position bigint"
        return spark.createDataFrame([], kind)
    rows = rows.select("user_id", "product_id", "category", "ts", "position")
    return windows.bounded_recommendations(rows).drop("rank")
