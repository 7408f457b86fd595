"""Scores, derived columns, filters and lookups (no shuffle in any of them,
except ``browse_category`` which sorts one category)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import scalars, weights
from clickloom.functions.times import bucket_start

# Event types that may change a user's recommendations.
IMPORTANT_TYPES = ("product_view", "click", "recommendation_click", "search")


def with_score(
    interactions: DataFrame, scoring: weights.Scoring, out: str = "score"
) -> DataFrame:
    """Add the points of each interaction under a scoring preset."""
    return interactions.withColumn(
        out, weights.score_of(F.col("interaction_type"), scoring)
    )


def parse_details(interactions: DataFrame) -> DataFrame:
    """Pull the known fields out of the ``details`` JSON; broken JSON gives NULLs."""
    names = ("action", "query", "product_name", "category")
    fields = {f"detail_{n}": F.get_json_object("details", f"$.{n}") for n in names}
    return interactions.withColumns(fields)


def with_cascade_family(interactions: DataFrame) -> DataFrame:
    """Family and points of the staged recommender; a click that put the product
    into the cart earns the bonus on top. Other types get no family."""
    kind = F.col("interaction_type")
    to_cart = F.get_json_object("details", "$.action") == "add_to_cart"
    bonus = F.when(
        kind.isin(*weights.CLICK_TYPES) & to_cart, F.lit(weights.ADD_TO_CART_BONUS)
    ).otherwise(F.lit(0))
    return interactions.withColumns(
        {
            "family": weights.family_of(kind, weights.CASCADE),
            "score": weights.family_points(kind, weights.CASCADE) + bonus,
        }
    )


def with_simple_family(interactions: DataFrame) -> DataFrame:
    """Clicked / viewed family with points; interactions of other types go."""
    kind = F.col("interaction_type")
    return interactions.withColumns(
        {
            "family": weights.family_of(kind, weights.SIMPLE),
            "score": weights.family_points(kind, weights.SIMPLE),
        }
    ).filter(F.col("family").isNotNull())


def with_time_columns(interactions: DataFrame, ts: str = "ts") -> DataFrame:
    """Hour of day (0-23) and day of week (1 = Sunday)."""
    return interactions.withColumns(
        {"hour_of_day": F.hour(ts), "day_of_week": F.dayofweek(ts)}
    )


def with_price_band(
    df: DataFrame, price: str, edges: Sequence[float], labels: Sequence[str], out: str = "price_band"
) -> DataFrame:
    return df.withColumn(out, scalars.price_band(F.col(price), edges, labels))


def important_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type").isin(*IMPORTANT_TYPES))


def click_like(kind: Column) -> Column:
    """True for every type that mentions a click."""
    return scalars.contains_click(kind)


def complete_pairs(df: DataFrame, *extra: str) -> DataFrame:
    """Rows with a user and a product (and each extra column)."""
    for name in ("user_id", "product_id", *extra):
        df = df.filter(F.col(name).isNotNull())
    return df


def product_search(products: DataFrame, query: str = "", category: str = "") -> DataFrame:
    """Products whose name or description holds the query, ignoring case.

    An empty query or category does not restrict. The query is plain text:
    ``%`` and ``_`` have no special meaning.
    """
    query, category = query.strip().lower(), category.strip()
    out = products
    if query:
        hit = F.lower("name").contains(query)
        if "description" in products.columns:
            hit = hit | F.coalesce(F.lower("description").contains(query), F.lit(False))
        out = out.filter(hit)
    if category:
        out = out.filter(F.col("category") == category)
    return out


def browse_category(
    products: DataFrame, category: str, page: int = 1, size: int = 12
) -> DataFrame:
    """One page of a category by id, with the category's total in ``total``."""
    rows = products.filter(F.col("category") == category)
    total = rows.agg(F.count("*").alias("total"))
    return (
        rows.orderBy("product_id")
        .offset((page - 1) * size)
        .limit(size)
        .withColumn("total", total.scalar())
    )


def normalise_event_type(events: DataFrame) -> DataFrame:
    """Add ``raw_type`` (the browser's own type) and ``normalised_type``.

    The web tier hides the browser's type in ``data.event_type``; the plain
    ``event_type`` is used when it is absent.
    """
    raw = F.coalesce(F.try_element_at("data", F.lit("event_type")), F.col("event_type"))
    return events.withColumns(
        {"raw_type": raw, "normalised_type": scalars.normalised_type(raw)}
    )


def extract_product_id(events: DataFrame) -> DataFrame:
    return events.withColumn("product_id", scalars.product_id_of(F.col("data")))


def to_interaction(events: DataFrame) -> DataFrame:
    """Interaction rows of the events that have one.

    A plain click needs both an action and a product; card and recommendation
    clicks need a product; other event types make no interaction.
    """
    kind = F.coalesce(F.try_element_at("data", F.lit("event_type")), F.col("event_type"))
    product = F.try_element_at("data", F.lit("product_id")).try_cast("long")
    action = F.try_element_at("data", F.lit("action"))
    recommended = F.lower(F.try_element_at("data", F.lit("is_recommendation"))) == "true"
    has_product = product.isNotNull()
    name = (
        F.when(kind == "product_view", F.lit("view"))
        .when((kind == "click") & has_product & (action != ""), F.concat(F.lit("click_"), action))
        .when(
            (kind == "product_card_click") & has_product,
            F.when(recommended, F.lit("card_click_recommendation")).otherwise("card_click"),
        )
        .when((kind == "recommendation_click") & has_product, F.lit("recommendation_click"))
    )
    return events.select(
        *[c for c in ("event_id",) if c in events.columns],
        "user_id",
        product.alias("product_id"),
        name.alias("interaction_type"),
        F.to_json("data").alias("details"),
        "ts",
    ).filter(F.col("interaction_type").isNotNull())


def hydrate_ranked(lists: DataFrame, products: DataFrame, ids: str = "product_ids") -> DataFrame:
    """Product rows of a ranked id list, in list order; unknown ids drop out."""
    keys = [c for c in lists.columns if c != ids]
    ranked = lists.select(*keys, F.posexplode(ids).alias("_pos", "product_id"))
    ranked = ranked.withColumn("rank", (F.col("_pos") + 1).cast("int")).drop("_pos")
    return ranked.join(products, "product_id")


def lookup_product(products: DataFrame, product_id: int) -> DataFrame:
    return products.filter(F.col("product_id") == product_id)
