"""Joins between interactions, products, users and relations.

No join forces a broadcast. Spark broadcasts a side when its measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where
adaptive skew handling splits hot keys of the interaction side. Interactions
without a product would all meet in one task as NULL keys; they are spread over
a second key column that only the NULL rows vary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.ranking import top_n_per_group
from clickloom.functions.times import AsOf, time_literal, to_datetime, trailing_window

NULL_SPREAD = 1024


def left_join_sparse(
    left: DataFrame, right: DataFrame, key: str, row_id: str, right_key: str | None = None
) -> DataFrame:
    """Left join on a nullable key; rows with a NULL key are spread by ``row_id``.

    ``right`` is not replicated: its rows carry the spread value 0. That value is
    computed from the key (a remainder by 1) because the optimizer would turn a
    constant into a filter and leave the join with the plain key. With both
    columns as keys each side has its own exchange, so adaptive execution can
    still broadcast a side that turns out small or split a hot key.
    """
    right_key = right_key or key
    piece = F.when(
        F.col(key).isNull(), F.pmod(F.xxhash64(row_id), F.lit(NULL_SPREAD))
    ).otherwise(F.lit(0).cast("long"))
    a = left.withColumn("_spread", piece)
    b = right.withColumnRenamed(right_key, "_right_key").withColumn(
        "_right_spread", F.pmod(F.xxhash64("_right_key"), F.lit(1).cast("long"))
    )
    on = (F.col(key) == F.col("_right_key")) & (F.col("_spread") == F.col("_right_spread"))
    return a.join(b, on, "left").drop("_right_key", "_spread", "_right_spread")


def interactions_inner_product(interactions: DataFrame, products: DataFrame) -> DataFrame:
    """Interactions that have a known product, with its columns."""
    return interactions.join(products, "product_id")


def interactions_left_product(
    interactions: DataFrame, products: DataFrame, row_id: str = "interaction_id"
) -> DataFrame:
    """All interactions; product columns are NULL where there is no product."""
    return left_join_sparse(interactions, products, "product_id", row_id)


def product_counts(interactions: DataFrame, out: str = "interaction_count") -> DataFrame:
    """Interactions per product; the reduced side of the product joins."""
    return (
        interactions.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.count("*").alias(out))
    )


def products_left_recent(
    products: DataFrame, interactions: DataFrame, as_of: AsOf, days: int = 7
) -> DataFrame:
    """Every product with its number of interactions in the window (0 kept).

    The window sits in the join condition, so it is applied to the interactions
    first and only one counted row per product is joined.
    """
    counts = product_counts(trailing_window(interactions, as_of, days=days))
    joined = products.join(counts, "product_id", "left")
    return joined.withColumn(
        "interaction_count", F.coalesce("interaction_count", F.lit(0).cast("long"))
    )


def recent_counts_where(interactions: DataFrame, as_of: AsOf, days: int = 7) -> DataFrame:
    """Per product: all interactions ever (``total``) and those in the window
    (``recent``), the two numbers the WHERE form of the join needs."""
    since = time_literal(interactions, "ts", as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    now = time_literal(interactions, "ts", to_datetime(as_of))
    in_window = (F.col("ts") >= since) & (F.col("ts") <= now)
    return (
        interactions.filter(F.col("product_id").isNotNull() & (F.col("ts") <= now))
        .groupBy("product_id")
        .agg(F.count("*").alias("total"), F.count_if(in_window).alias("recent"))
    )


def products_left_recent_where(
    products: DataFrame, interactions: DataFrame, as_of: AsOf, days: int = 7
) -> DataFrame:
    """As ``products_left_recent`` with the window applied after the join:
    products never used stay with 0, products only used earlier disappear."""
    counts = recent_counts_where(interactions, as_of, days)
    joined = products.join(counts, "product_id", "left")
    kept = joined.filter(F.col("total").isNull() | (F.col("recent") > 0))
    return kept.withColumn(
        "interaction_count", F.coalesce("recent", F.lit(0).cast("long"))
    ).drop("total", "recent")


def users_left_interactions(users: DataFrame, interactions: DataFrame) -> DataFrame:
    """Every user with each of their interactions; users without any stay once.

    Written as an inner join plus the users that have none: adaptive execution
    can split a hot user in an inner join, but not on the optional side of an
    outer join.
    """
    matched = users.join(interactions, "user_id")
    active = interactions.select("user_id").distinct()
    idle = users.join(active, "user_id", "left_anti")
    return matched.unionByName(idle, allowMissingColumns=True)


def interactions_user_product(
    interactions: DataFrame, users: DataFrame, products: DataFrame
) -> DataFrame:
    """Interactions with user and product names; ids stand in for unknown names."""
    names = users.select("user_id", "username")
    goods = products.select("product_id", F.col("name").alias("product_name"))
    joined = interactions_left_product(interactions, goods).join(names, "user_id", "left")
    return joined.withColumns(
        {
            "username": F.coalesce("username", F.concat(F.lit("User "), F.col("user_id"))),
            "product_name": F.coalesce(
                "product_name", F.concat(F.lit("Product "), F.col("product_id"))
            ),
        }
    )


def exclude_ids(candidates: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates whose keys are not in ``seen``; a NULL key never excludes."""
    return candidates.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def in_ids(products: DataFrame, wanted: DataFrame, key: str = "product_id") -> DataFrame:
    """Products whose key occurs in ``wanted``."""
    return products.join(wanted.select(key).distinct(), key, "left_semi")


def related_categories(df: DataFrame, relations: DataFrame, n: int = 2) -> DataFrame:
    """First ``n`` related categories of each row's category, with their rank."""
    return df.join(relations.filter(F.col("rel_rank") <= n), "category")


def similar_products(
    favourites: DataFrame, products: DataFrame, n: int = 3, per_user: int = 5
) -> DataFrame:
    """Per user, the ``n`` newest products of the categories of their favourite
    products, without the favourites themselves.

    ``favourites(user_id, product_id)`` holds at most ``per_user`` rows per user,
    so the newest ``n + per_user`` products of a category always suffice.
    """
    newest = [F.desc("created_at"), F.desc("product_id")]
    shelf = top_n_per_group(
        products.select("product_id", "category", "created_at"),
        ["category"],
        newest,
        n + per_user,
        rank="shelf_rank",
        spread_by="product_id",
    ).drop("shelf_rank")
    kinds = (
        favourites.join(products.select("product_id", "category"), "product_id")
        .select("user_id", "category")
        .distinct()
    )
    candidates = exclude_ids(
        kinds.join(shelf, "category"), favourites, ["user_id", "product_id"]
    )
    return top_n_per_group(candidates, ["user_id"], newest, n)


def with_scalar_total(df: DataFrame, counted: DataFrame, out: str) -> DataFrame:
    """Attach the row count of ``counted`` to every row as a scalar subquery."""
    total = counted.agg(F.count("*").alias(out))
    return df.withColumn(out, total.scalar())
