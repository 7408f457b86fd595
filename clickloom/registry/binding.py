"""The supplied benchmark tables seen as interactions, products, users, events.

``events.props.k`` is the product; ``part`` the product dimension with its type
as category; ``customer`` the users. Two relabelled views give the remaining
interaction and event types: they keep every row and only rename its type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.model import relations_table

AS_OF = "2024-01-31 00:00:00"

# Related categories of the supplied product types: the next three, cyclic.
PART_RELATIONS = {
    "ECONOMY": ["LARGE", "MEDIUM", "PROMO"],
    "LARGE": ["MEDIUM", "PROMO", "SMALL"],
    "MEDIUM": ["PROMO", "SMALL", "STANDARD"],
    "PROMO": ["SMALL", "STANDARD", "ECONOMY"],
    "SMALL": ["STANDARD", "ECONOMY", "LARGE"],
    "STANDARD": ["ECONOMY", "LARGE", "MEDIUM"],
}
# The interaction types whose shares stand for the factors of a model.
PREDICTED_TYPES = ("view", "click", "search", "category_view", "recommendation_click")
DEFAULT_CATEGORY = "ECONOMY"
PRICE_EDGES = (902, 905, 907, 909)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _product() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def interactions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("interaction_id"),
        "user_id",
        _product().alias("product_id"),
        F.col("event_type").alias("interaction_type"),
        F.col("props").alias("details"),
        "ts",
    )


def shop_interactions(spark: SparkSession, sf: str) -> DataFrame:
    """Interactions with the shop's own types: searches (some without a product),
    category views with broken details, and clicks that fill the cart."""
    kind = F.col("event_type")
    name = (
        F.when(kind == "purchase", F.lit("recommendation_click"))
        .when(kind == "signup", F.lit("search"))
        .when(kind == "error", F.lit("category_view"))
        .otherwise(kind)
    )
    product = F.when(~((kind == "signup") & (F.col("value") < 10)), _product())
    details = (
        F.when((kind == "click") & (F.col("value") >= 20), F.lit('{"action": "add_to_cart"}'))
        .when(kind == "signup", F.concat(F.lit('{"query": "k'), _product(), F.lit('"}')))
        .when(kind == "error", F.lit("not json"))
    )
    return table(spark, sf, "events").select(
        F.col("event_id").alias("interaction_id"),
        "user_id",
        product.alias("product_id"),
        name.alias("interaction_type"),
        details.alias("details"),
        "ts",
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    created = F.to_timestamp_ntz(F.lit("2020-01-01 00:00:00")) + F.make_dt_interval(
        mins=F.col("p_partkey").cast("int")
    )
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("description"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("stock"),
        created.alias("created_at"),
    )


def users(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username")
    )


def relations(spark: SparkSession, sf: str) -> DataFrame:
    return relations_table(spark, PART_RELATIONS)


def web_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events of the web shop with their payload map."""
    goods = table(spark, sf, "part").select(
        F.col("p_partkey").alias("k"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )
    rows = table(spark, sf, "events").withColumn("k", _product()).join(goods, "k", "left")
    kind = F.col("event_type")
    name = (
        F.when(kind == "view", F.lit("product_view"))
        .when(kind == "purchase", F.lit("recommendation_click"))
        .when(kind == "signup", F.lit("search"))
        .when(kind == "error", F.lit("page_view"))
        .otherwise(kind)
    )
    text = lambda c: F.col(c).cast("string")
    action = F.when(F.col("value") >= 20, F.lit("add_to_cart")).otherwise(F.lit("view_product"))
    on_product = F.create_map(
        F.lit("product_id"), text("k"), F.lit("category"), F.col("category"),
        F.lit("price"), text("price"), F.lit("action"), action,
    )
    on_search = F.create_map(
        F.lit("query"), F.concat(F.lit("k"), text("k")), F.lit("results_count"), text("k")
    )
    on_page = F.create_map(F.lit("page"), F.concat(F.lit("/product/"), text("k")))
    data = F.when(kind == "signup", on_search).when(kind == "error", on_page).otherwise(on_product)
    return rows.select(
        "event_id",
        "user_id",
        name.alias("event_type"),
        data.alias("data"),
        "ts",
        F.concat(F.lit("tab_"), text("user_id"), F.lit("_"), kind).alias("session_id"),
    )


def page_events(spark: SparkSession, sf: str) -> DataFrame:
    """Page load, scroll, blur and unload events with whole-number payloads."""
    kind = F.col("event_type")
    whole = F.floor(F.col("value") * 100).cast("bigint").cast("string")
    name = (
        F.when(kind == "click", F.lit("page_load"))
        .when(kind == "view", F.lit("scroll_depth"))
        .when(kind == "purchase", F.lit("page_blur"))
        .when(kind == "error", F.lit("page_unload"))
        .otherwise(kind)
    )
    page = F.concat(F.lit("/product/"), _product().cast("string"))
    field = F.when(kind == "click", F.lit("load_time")).when(
        kind == "view", F.lit("depth")
    ).otherwise(F.lit("time_spent"))
    return table(spark, sf, "events").select(
        "event_id", "user_id", name.alias("event_type"),
        F.create_map(F.lit("page"), page, field, whole).alias("data"), "ts",
    )


def heartbeats(spark: SparkSession, sf: str) -> DataFrame:
    """One tab per (user, type); the tabs of one type are not logged in."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id",
        F.when(kind != "error", F.col("user_id")).alias("user_id"),
        F.concat(F.lit("tab_"), F.col("user_id").cast("string"), F.lit("_"), kind).alias("session_id"),
        "ts",
    )


def past_recommendations(spark: SparkSession, sf: str) -> DataFrame:
    """Products the user had been offered: those bought before the last day."""
    goods = products(spark, sf).select("product_id", "category")
    cut = F.to_timestamp_ntz(F.lit("2024-01-30 00:00:00"))
    return (
        interactions(spark, sf)
        .filter((F.col("interaction_type") == "purchase") & (F.col("ts") < cut))
        .select("user_id", "product_id", "ts", F.col("interaction_id").alias("position"))
        .join(goods, "product_id")
        .select("user_id", "product_id", "category", "ts", "position")
    )


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as purchase interactions."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"
    )
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return lines.join(orders, "l_orderkey").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("interaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        F.lit("purchase").alias("interaction_type"),
        F.lit(None).cast("string").alias("details"),
        F.col("o_orderdate").alias("ts"),
    )
