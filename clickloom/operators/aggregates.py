"""Behaviour aggregates.

Interactions are first reduced to one row per (user, product) or per product,
with partial aggregation before the shuffle, and only then joined to products.
A hot user or product is one reduced row per partner by the time it is joined.
Money is summed as decimals, so a result does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import scalars, weights
from clickloom.functions.ranking import best_key, top_n_per_group
from clickloom.functions.scalars import exact_money, ratio
from clickloom.functions.times import AsOf, time_literal, trailing_window
from clickloom.model import PRICE_EDGES, PRICE_LABELS
from clickloom.operators.joins import left_join_sparse, product_counts
from clickloom.operators.projections import click_like, with_cascade_family


# Rule segment thresholds (interactions, click-through rate).
SEGMENT_RULES = (
    ("high_engagement", 50, 0.1),
    ("medium_engagement", 20, 0.05),
    ("low_engagement", 5, None),
)
SEGMENT_OTHER = "new_user"

# Event types that feed the profile counters.
PROFILE_CATEGORY_TYPES = ("product_view", "click", "recommendation_click")
PROFILE_PRICE_TYPES = ("product_view", "click")


def times_seen(interactions: DataFrame) -> Column:
    """How many interactions a row stands for: its ``n``, where rows are counted already."""
    return F.col("n") if "n" in interactions.columns else F.lit(1).cast("long")


def pair_scores(interactions: DataFrame, scoring: weights.Scoring) -> DataFrame:
    """Score and count per (user, product)."""
    points = weights.score_of(F.col("interaction_type"), scoring)
    seen = times_seen(interactions)
    return interactions.groupBy("user_id", "product_id").agg(
        F.sum(points * seen).alias("score"), F.sum(seen).alias("n")
    )


def user_product_scores(
    interactions: DataFrame, products: DataFrame, scoring: weights.Scoring = weights.PREFERENCE
) -> DataFrame:
    """Total score per (user, product) with the product's category and price."""
    goods = products.select("product_id", "category", "price")
    pairs = pair_scores(interactions, scoring).join(goods, "product_id")
    return pairs.select(
        "user_id", "product_id", F.col("score").alias("total_score"), "category", "price"
    )


def category_preferences(
    interactions: DataFrame, products: DataFrame, scoring: weights.Scoring = weights.PREFERENCE
) -> DataFrame:
    """Preference score and number of interactions per (user, category)."""
    goods = products.select("product_id", "category")
    return (
        pair_scores(interactions, scoring)
        .join(goods, "product_id")
        .groupBy("user_id", "category")
        .agg(F.sum("score").alias("category_score"), F.sum("n").alias("interaction_count"))
    )


def trending_products(
    interactions: DataFrame, products: DataFrame, as_of: AsOf, days: int = 7, n: int = 20
) -> DataFrame:
    """The ``n`` products of highest trending score in the window."""
    recent = trailing_window(interactions, as_of, days=days)
    points = weights.score_of(F.col("interaction_type"), weights.TRENDING)
    stats = recent.groupBy("product_id").agg(
        F.count_distinct("user_id").alias("unique_users"),
        F.count("*").alias("total_interactions"),
        F.sum(points).alias("trending_score"),
    )
    goods = products.select("product_id", F.col("name").alias("product_name"), "category")
    return stats.join(goods, "product_id").orderBy(F.desc("trending_score"), "product_id").limit(n)


def segment_of(total: Column, ctr: Column) -> Column:
    """Rule segment of a user from volume and click-through rate."""
    out = F.lit(SEGMENT_OTHER)
    for name, least_total, least_ctr in reversed(SEGMENT_RULES):
        test = total >= least_total
        if least_ctr is not None:
            test = test & (ctr >= least_ctr)
        out = F.when(test, F.lit(name)).otherwise(out)
    return out


def user_segments_rule(interactions: DataFrame, products: DataFrame) -> DataFrame:
    """Volume, variety, average price, click-through rate and rule segment per user."""
    kind = F.col("interaction_type")
    seen = times_seen(interactions)
    pairs = interactions.groupBy("user_id", "product_id").agg(
        F.sum(seen).alias("n"),
        F.sum(F.when(click_like(kind), seen).otherwise(0)).alias("clicks"),
        F.sum(F.when(kind == "view", seen).otherwise(0)).alias("views"),
    )
    goods = products.select("product_id", "category", exact_money(F.col("price")).alias("price"))
    users = (
        pairs.join(goods, "product_id")
        .groupBy("user_id")
        .agg(
            F.sum("n").alias("total_interactions"),
            F.count("*").alias("unique_products"),
            F.sum(F.col("price") * F.col("n")).alias("_spent"),
            F.sum(F.when(F.col("price").isNotNull(), F.col("n"))).alias("_priced"),
            F.count_distinct("category").alias("categories_explored"),
            F.sum("clicks").alias("click_count"),
            F.sum("views").alias("view_count"),
        )
    )
    ctr = F.when(
        F.col("view_count") > 0, F.col("click_count") / F.col("view_count")
    ).otherwise(F.lit(0.0))
    return (
        users.withColumn("avg_price_interest", ratio(F.col("_spent"), F.col("_priced")))
        .withColumn("ctr", ctr)
        .withColumn("segment", segment_of(F.col("total_interactions"), F.col("ctr")))
        .drop("_spent", "_priced")
    )


def user_features(
    interactions: DataFrame,
    products: DataFrame,
    as_of: AsOf,
    least: int = 5,
    recent_days: int = 7,
    ordered: bool = True,
) -> DataFrame:
    """Thirteen behaviour features per user with at least ``least`` interactions.

    Interactions are reduced to one row per (user, product, day). One branch folds
    them by product and category, the other by day, each level counting the rows
    of the level below, so no distinct count has to multiply its input. Weekday
    shares are seven conditional sums.
    """
    kind = F.col("interaction_type")
    points = weights.score_of(kind, weights.ENGAGEMENT)
    known = interactions.filter(
        F.col("user_id").isNotNull() & (F.col("ts") <= time_literal(interactions, "ts", as_of))
    )
    daily = known.groupBy("user_id", "product_id", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"),
        F.sum(points).alias("score"),
        F.sum(F.hour("ts").cast("long")).alias("hours"),
        F.count_if(kind == "click").alias("clicks"),
        F.count_if(kind == "view").alias("views"),
    )

    goods = products.select("product_id", "category", exact_money(F.col("price")).alias("price"))
    per_product = daily.groupBy("user_id", "product_id").agg(
        *[F.sum(c).alias(c) for c in ("n", "score", "clicks", "views")]
    )
    per_category = (
        left_join_sparse(per_product, goods, "product_id", "user_id")
        .groupBy("user_id", "category")
        .agg(
            *[F.sum(c).alias(c) for c in ("n", "score", "clicks", "views")],
            F.count("product_id").alias("products"),
            F.sum(F.col("price") * F.col("n")).alias("spent"),
            F.sum(F.when(F.col("price").isNotNull(), F.col("n"))).alias("priced"),
        )
    )
    by_taste = per_category.groupBy("user_id").agg(
        F.sum("n").alias("total_interactions"),
        F.sum("products").alias("unique_products_viewed"),
        F.count("category").alias("categories_explored"),
        F.sum("score").alias("total_engagement_score"),
        best_key(F.col("n"), F.col("category")).alias("most_viewed_category"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("views").alias("total_views"),
        ratio(F.sum("spent"), F.sum("priced")).alias("avg_product_price_viewed"),
    ).filter(F.col("total_interactions") >= least)

    today = F.to_date(time_literal(interactions, "ts", as_of))
    recent = F.col("day") >= F.date_sub(today, recent_days)
    days = range(1, 8)
    on_day = lambda d: F.sum(
        F.when(F.dayofweek("day") == d, F.col("n")).otherwise(F.lit(0))
    )
    by_day = (
        daily.groupBy("user_id", "day")
        .agg(*[F.sum(c).alias(c) for c in ("n", "score", "hours")])
        .groupBy("user_id")
        .agg(
            F.count("*").alias("active_days"),
            F.sum("hours").alias("_hours"),
            F.sum(F.when(recent, F.col("score")).otherwise(F.lit(0))).alias("recent_engagement"),
            *[on_day(d).alias(f"_wd{d}") for d in days],
        )
    )
    favourite_day = F.array_min(
        F.array(*[F.struct((-F.col(f"_wd{d}")).alias("w"), F.lit(d).alias("d")) for d in days])
    )["d"]
    out = by_taste.join(by_day, "user_id").select(
        "user_id",
        "total_interactions",
        "unique_products_viewed",
        "categories_explored",
        "total_engagement_score",
        ratio(F.col("total_engagement_score"), F.col("total_interactions")).alias(
            "avg_interaction_intensity"
        ),
        "active_days",
        ratio(F.col("_hours"), F.col("total_interactions")).alias("avg_hour_activity"),
        favourite_day.alias("favorite_day_of_week"),
        "most_viewed_category",
        "recent_engagement",
        "total_clicks",
        "total_views",
        "avg_product_price_viewed",
    )
    return out.orderBy(F.desc("total_engagement_score"), "user_id") if ordered else out


def implicit_ratings(interactions: DataFrame, least: float = 1.0) -> DataFrame:
    """Rating 1..5 per (user, product) from score and volume; weaker pairs go."""
    points = weights.score_of(F.col("interaction_type"), weights.ENGAGEMENT)
    pairs = (
        interactions.filter(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("user_id", "product_id")
        .agg(
            F.sum(points).alias("total_score"),
            F.count("*").alias("interaction_count"),
            F.max("ts").alias("last_interaction"),
        )
    )
    rating = F.least(
        F.lit(5.0), F.ln(F.col("total_score") + 1) + F.col("interaction_count") / 10
    )
    return pairs.withColumn("rating", rating).filter(F.col("rating") >= least)


def user_activity_summary(
    interactions: DataFrame, products: DataFrame, as_of: AsOf, days: int = 7
) -> DataFrame:
    """Volume, variety, last activity and average price per user in the window."""
    pairs = (
        trailing_window(interactions, as_of, days=days)
        .groupBy("user_id", "product_id")
        .agg(F.count("*").alias("n"), F.max("ts").alias("last"))
    )
    goods = products.select("product_id", "category", exact_money(F.col("price")).alias("price"))
    users = (
        left_join_sparse(pairs, goods, "product_id", "user_id")
        .groupBy("user_id")
        .agg(
            F.sum("n").alias("total_interactions"),
            F.count("product_id").alias("unique_products"),
            F.count_distinct("category").alias("categories_explored"),
            F.max("last").alias("last_activity"),
            F.sum(F.col("price") * F.col("n")).alias("_spent"),
            F.sum(F.when(F.col("price").isNotNull(), F.col("n"))).alias("_priced"),
        )
    )
    return (
        users.withColumn("avg_product_price", ratio(F.col("_spent"), F.col("_priced")))
        .drop("_spent", "_priced")
        .orderBy(F.desc("total_interactions"), "user_id")
    )


def category_product_counts(products: DataFrame, interactions: DataFrame) -> DataFrame:
    """Interactions per (category, product), products without any included."""
    joined = products.select("product_id", "category", "price").join(
        product_counts(interactions), "product_id", "left"
    )
    return joined.select(
        "category",
        "product_id",
        F.coalesce("interaction_count", F.lit(0).cast("long")).alias("interaction_count"),
        F.col("price").alias("avg_price"),
    )


def category_counts(products: DataFrame, interactions: DataFrame) -> DataFrame:
    """Interactions and average price per category over product-interaction rows
    (a product without interactions is one row)."""
    per_product = category_product_counts(products, interactions)
    rows = F.greatest("interaction_count", F.lit(1))
    return (
        per_product.groupBy("category")
        .agg(
            F.sum("interaction_count").alias("interaction_count"),
            F.sum(exact_money(F.col("avg_price")) * rows).alias("_value"),
            F.sum(F.when(F.col("avg_price").isNotNull(), rows)).alias("_rows"),
        )
        .withColumn("avg_price", ratio(F.col("_value"), F.col("_rows")))
        .drop("_value", "_rows")
    )


def counts_by_type(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("interaction_type").agg(F.count("*").alias("interaction_count"))


def top_users(interactions: DataFrame, users: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most active users; only those are joined to their names."""
    best = (
        interactions.groupBy("user_id")
        .agg(F.count("*").alias("interaction_count"))
        .orderBy(F.desc("interaction_count"), "user_id")
        .limit(n)
    )
    named = best.join(users.select("user_id", "username"), "user_id", "left")
    return named.withColumn(
        "username", F.coalesce("username", F.concat(F.lit("User "), F.col("user_id")))
    ).orderBy(F.desc("interaction_count"), "user_id")


def user_type_counts(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("user_id", "interaction_type").agg(
        F.count("*").alias("interaction_count")
    )


def user_type_matrix(
    users: DataFrame, interactions: DataFrame, types: Sequence[str] = ("click", "view", "search")
) -> DataFrame:
    """One column per interaction type for every user, 0 where there is none."""
    kind = F.col("interaction_type")
    counts = interactions.groupBy("user_id").agg(
        *[F.count_if(kind == t).alias(f"{t}_count") for t in types],
        F.count("*").alias("total_count"),
    )
    names = [f"{t}_count" for t in types] + ["total_count"]
    joined = users.select("user_id").join(counts, "user_id", "left")
    return joined.fillna(0, subset=names)


def user_totals(users: DataFrame, interactions: DataFrame) -> DataFrame:
    """Interactions and distinct products of every user, 0 included."""
    counts = (
        interactions.groupBy("user_id", "product_id")
        .agg(F.count("*").alias("n"))
        .groupBy("user_id")
        .agg(
            F.sum("n").alias("total_interactions"),
            F.count("product_id").alias("unique_products"),
        )
    )
    joined = users.select("user_id").join(counts, "user_id", "left")
    return joined.fillna(0, subset=["total_interactions", "unique_products"])


def category_sizes(products: DataFrame) -> DataFrame:
    return products.groupBy("category").agg(F.count("*").alias("product_count"))


def product_counters(interactions: DataFrame) -> DataFrame:
    """Count per (product, action) with the product's total over all actions."""
    by_action = (
        interactions.filter(F.col("product_id").isNotNull())
        .groupBy("product_id", F.col("interaction_type").alias("action"))
        .agg(F.count("*").alias("action_count"))
    )
    # A product has at most one row per action here, so the window is small.
    per_product = Window.partitionBy("product_id")
    return by_action.withColumn(
        "total_interactions", F.sum("action_count").over(per_product)
    )


def profile_entries(
    events: DataFrame,
    category_types: Sequence[str] = PROFILE_CATEGORY_TYPES,
    price_types: Sequence[str] = PROFILE_PRICE_TYPES,
    edges: Sequence[float] = PRICE_EDGES,
    labels: Sequence[str] = PRICE_LABELS,
) -> DataFrame:
    """(user, time, kind, value) rows: the category and the price band of an event."""
    kind = F.col("event_type")
    category = F.when(
        kind.isin(*category_types), F.try_element_at("data", F.lit("category"))
    )
    band = F.when(
        kind.isin(*price_types),
        scalars.price_band(F.try_element_at("data", F.lit("price")), edges, labels),
    )
    entry = F.inline(
        F.array(
            F.struct(F.lit("category").alias("kind"), category.alias("value")),
            F.struct(F.lit("price_range").alias("kind"), band.alias("value")),
        )
    )
    known = events.filter(kind.isin(*{*category_types, *price_types}))
    return known.select("user_id", "ts", entry).filter(F.col("value").isNotNull() & (F.col("value") != ""))


def user_profile_counters(
    events: DataFrame,
    edges: Sequence[float] = PRICE_EDGES,
    labels: Sequence[str] = PRICE_LABELS,
) -> DataFrame:
    """Category and price-band counters per user."""
    return (
        profile_entries(events, edges=edges, labels=labels)
        .groupBy("user_id", "kind", "value")
        .agg(F.count("*").alias("count"))
    )


def clicked_recommendations(events: DataFrame) -> DataFrame:
    """(product_id, time) of each click on a recommended product."""
    product = F.try_element_at("data", F.lit("product_id")).try_cast("long")
    rows = events.filter(F.col("event_type") == "recommendation_click")
    return rows.select(product.alias("product_id"), "ts").filter(F.col("product_id").isNotNull())


def recommendation_clicks(events: DataFrame) -> DataFrame:
    """Clicks per recommended product."""
    return clicked_recommendations(events).groupBy("product_id").agg(F.count("*").alias("clicks"))


def shopping_patterns(interactions: DataFrame) -> DataFrame:
    """Per user: put-into-cart clicks and searches per query text."""
    kind = F.col("interaction_type")
    query = F.get_json_object("details", "$.query")
    to_cart = F.get_json_object("details", "$.action") == "add_to_cart"
    pattern = F.when(
        kind.isin(*weights.CLICK_TYPES) & to_cart, F.lit("add_to_cart")
    ).when((kind == "search") & (query != ""), F.concat(F.lit("search:"), query))
    return (
        interactions.select("user_id", pattern.alias("pattern"))
        .filter(F.col("pattern").isNotNull())
        .groupBy("user_id", "pattern")
        .agg(F.count("*").alias("count"))
    )


def favourite_products(
    interactions: DataFrame, n: int = 5, types: Sequence[str] = weights.VIEW_TYPES
) -> DataFrame:
    """Each user's ``n`` products with most interactions of the given types."""
    counts = (
        interactions.filter(
            F.col("interaction_type").isin(*types) & F.col("product_id").isNotNull()
        )
        .groupBy("user_id", "product_id")
        .agg(F.count("*").alias("interaction_count"))
    )
    return top_n_per_group(
        counts,
        ["user_id"],
        [F.desc("interaction_count"), F.asc("product_id")],
        n,
        spread_by="product_id",
    )


def user_interests(
    events: DataFrame,
    edges: Sequence[float] = PRICE_EDGES,
    labels: Sequence[str] = PRICE_LABELS,
) -> DataFrame:
    """Category and price-band counts plus distinct recent products per user.

    Rows are (user, kind, value, count, first_ts); products are of kind
    ``recent_product`` and ordered by the time they were first seen.
    """
    kind = F.col("event_type")
    data = lambda name: F.try_element_at("data", F.lit(name))
    band = scalars.price_band(data("price"), edges, labels)
    product = scalars.product_id_of(F.col("data")).cast("string")
    entry = F.inline(
        F.array(
            F.struct(F.lit("category").alias("kind"), data("category").alias("value")),
            F.struct(F.lit("price_range").alias("kind"), band.alias("value")),
            F.struct(F.lit("recent_product").alias("kind"), product.alias("value")),
        )
    )
    return (
        events.filter(kind.isin(*PROFILE_CATEGORY_TYPES))
        .select("user_id", "ts", entry)
        .filter(F.col("value").isNotNull() & (F.col("value") != ""))
        .groupBy("user_id", "kind", "value")
        .agg(F.count("*").alias("count"), F.min("ts").alias("first_ts"))
    )
