"""Batch recommenders: one job makes the lists of all users.

Each function returns one row per user: ``user_id, strategy_used,
recommendations`` (an ordered array of product_id, priority, reason) and a few
profile columns. ``explode_recommendations`` flattens the lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import weights
from clickloom.functions.ranking import best_key, seeded_key
from clickloom.functions.times import AsOf, time_literal
from clickloom.model import SHOP_DEFAULT_CATEGORY
from clickloom.operators import projections, windows
from clickloom.plans.picks import BLOCK_TYPE, PICK_TYPE, block, blocks, blocks_of, fill
from clickloom.plans.shelves import look_up, no_ids, shelf

# Texts shown with a recommendation.
REASONS = {
    "latest_click": "Dựa trên lần click gần nhất: ",
    "latest_view": "Dựa trên lần xem gần nhất: ",
    "frequent_category": "Bạn quan tâm đến {} ({} lần click)",
    "related_taste": "Liên quan đến sở thích của bạn về ",
    "similar_product": "Tương tự sản phẩm bạn đã quan tâm",
    "trending": "Sản phẩm đang được quan tâm nhiều",
    "same_category": "Cùng danh mục với '{}'",
    "related_category": "Liên quan đến '{}' - từ {}",
    "viewed_category": "Dựa trên danh mục bạn đã xem: ",
    "fallback": "Sản phẩm phổ biến",
    "main_category": "🔥 ",
    "related_short": "Liên quan: ",
    "instant": "🔥 INSTANT: ",
    "from_history": "Từ lần gợi ý trước: ",
    "related_to": "Liên quan đến ",
    "viewed": "Đã xem: ",
    "discovery": "Khám phá: ",
}


def _text(key: str, *values: Column) -> Column:
    """A reason text with column values in its placeholders, or after it."""
    parts = REASONS[key].split("{}")
    if len(parts) == 1:
        return F.concat(F.lit(parts[0]), *values)
    out: list[Column] = [F.lit(parts[0])]
    for value, part in zip(values, parts[1:]):
        out += [value.cast("string"), F.lit(part)]
    return F.concat(*out)


# --------------------------------------------------------------- staged (6)


def cascade_profile(recent: DataFrame) -> DataFrame:
    """One row per user with the categories and products the stages start from.

    ``recent`` is the capped history (at most ``n`` rows per user, partitioned by
    user), so the windows below stay inside that partitioning.
    """
    scored = projections.with_cascade_family(recent).filter("category IS NOT NULL").withColumns(
        {
            "click": F.col("interaction_type").isin(*weights.CLICK_TYPES),
            "view": F.col("interaction_type").isin(*weights.VIEW_TYPES),
        }
    )
    pairs = scored.groupBy("user_id", "category", "product_id").agg(
        F.expr("min(pos) FILTER (WHERE click) AS click_pos"),
        F.expr("min(pos) FILTER (WHERE view) AS view_pos"),
        F.expr("count_if(click) AS clicks"),
        F.expr("count_if(view) AS views"),
        F.expr("coalesce(sum(score) FILTER (WHERE family = 'clicked'), 0) AS clicked"),
        F.expr("coalesce(sum(score) FILTER (WHERE family = 'viewed'), 0) AS viewed"),
    )
    ranked = pairs.withColumn(
        "cat_clicked", F.expr("sum(clicked) OVER (PARTITION BY user_id, category)")
    ).withColumns(
        {
            "click_rank": F.expr(
                "dense_rank() OVER (PARTITION BY user_id ORDER BY cat_clicked DESC, category)"
            ),
            "view_rank": F.expr(
                "row_number() OVER (PARTITION BY user_id ORDER BY views DESC, product_id)"
            ),
        }
    )
    best = "max({}) FILTER (WHERE cat_clicked > 0 AND click_rank = {}) AS {}"
    liked = "max({}) FILTER (WHERE views > 0 AND view_rank = {}) AS {}"
    return ranked.groupBy("user_id").agg(
        F.expr("min_by(category, click_pos) AS click_category"),
        F.expr("min_by(category, view_pos) AS view_category"),
        F.expr("sum(clicked) AS clicked_score"),
        F.expr("sum(viewed) AS viewed_score"),
        *[F.expr(best.format("category", k, f"top{k}")) for k in (1, 2, 3)],
        *[F.expr(best.format("cat_clicked", k, f"top{k}_score")) for k in (1, 2, 3)],
        *[F.expr(liked.format("product_id", k, f"fav{k}")) for k in (1, 2, 3)],
        *[F.expr(liked.format("category", k, f"fav{k}_category")) for k in (1, 2, 3)],
    )


def recommend_cascade(
    users: DataFrame,
    interactions: DataFrame,
    products: DataFrame,
    relations: DataFrame,
    as_of: AsOf,
    n: int = 6,
    seed: str | int = 0,
) -> DataFrame:
    """Five stages, each only while a user's list is short of ``n``.

    (1) the category of the latest click (4 products), else of the latest view
    (3); (2) other often clicked categories (2 each); (3) related categories
    (1 each); (4) newest products like the favourites; (5) globally trending.
    """
    recent = windows.recent_per_user(interactions, products, as_of, days=7)
    profile = cascade_profile(recent)

    # A stage passes over at most the entries already listed, so these shelf
    # lengths always leave enough fresh products.
    trend = windows.top_products_in_category(
        products, n + 4, "trend", interactions=interactions, as_of=as_of
    )
    newest = windows.top_products_in_category(products, 6, "newest")
    shelves = shelf(trend, "ids").join(shelf(newest, "newest", "created_at"), "category")
    global_ids = (
        windows.global_trending(products, interactions, as_of, 2 * n, seed)
        .withColumn("_key", seeded_key(F.col("product_id"), seed))
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct((-F.col("interaction_count")).alias("w"), "_key", "product_id")
                )
            ).alias("g")
        )
        .select(F.col("g.product_id").alias("g"))
    )

    main = F.coalesce("click_category", "view_category")
    slots = {"main": main, **{f"top{k}": F.col(f"top{k}") for k in (1, 2, 3)}}
    slots |= {f"fav{k}": F.col(f"fav{k}_category") for k in (1, 2, 3)}
    looked_up = look_up(profile, slots, shelves, relations, ("top1", "top2"))
    df = users.select("user_id").join(looked_up, "user_id", "left")
    df = df.withColumn("main_category", main).withColumn("_global", global_ids.scalar())

    has_click = F.col("click_category").isNotNull()
    has_view = F.col("view_category").isNotNull()
    category = F.col("main_category")
    shelf_ids = F.col("main_shelf.ids")
    latest = F.when(
        has_click,
        F.array(block(shelf_ids, 4, "latest_click", _text("latest_click", category))).cast(BLOCK_TYPE),
    ).otherwise(
        blocks(has_view, block(shelf_ids, 3, "latest_view", _text("latest_view", category)))
    )

    def frequent(k: int) -> Column:
        top = F.col(f"top{k}")
        reason = _text("frequent_category", top, F.col(f"top{k}_score"))
        return blocks(
            top.isNotNull() & ~top.eqNullSafe(category),
            block(F.col(f"top{k}_shelf.ids"), 2, "frequent_category", reason),
        )

    both = F.concat("top1_related", "top2_related")
    related = blocks_of(
        F.slice(F.array_distinct(both), 1, 3),
        lambda e: block(e["ids"], 1, "related_category", _text("related_taste", e["category"])),
    )

    favourites = F.array_compact(F.array("fav1", "fav2", "fav3"))
    pooled = F.flatten(F.array_compact(F.array(*[F.col(f"fav{k}_shelf.newest") for k in (1, 2, 3)])))
    unliked = F.filter(
        F.array_distinct(pooled), lambda e: ~F.array_contains(favourites, e["product_id"])
    )
    similar = F.slice(F.sort_array(unliked, asc=False), 1, 3)["product_id"]

    everything = fill(
        n,
        latest,
        *[frequent(k) for k in (1, 2, 3)],
        related,
        F.array(
            block(similar, 3, "similar_product", F.lit(REASONS["similar_product"])),
            block(F.col("_global"), n, "trending", F.lit(REASONS["trending"])),
        ).cast(BLOCK_TYPE),
    )
    strategy = (
        F.when(has_click, F.lit("latest_click_based"))
        .when(has_view, F.lit("latest_view_based"))
        .when(F.col("clicked_score") > 0, F.lit("frequent_clicks_based"))
        .when(F.col("viewed_score") > 0, F.lit("frequent_views_based"))
        .otherwise(F.lit("trending_based"))
    )
    return df.select(
        "user_id",
        strategy.alias("strategy_used"),
        "main_category",
        everything.alias("recommendations"),
    )


# ------------------------------------------------------ same + related (8+2)


def simple_profile(recent: DataFrame) -> DataFrame:
    """Latest click and latest kept interaction of each user."""
    kept = projections.with_simple_family(recent).filter(F.col("category").isNotNull())
    clicked = F.when(F.col("family") == "clicked", F.col("pos"))
    return kept.groupBy("user_id").agg(
        F.min_by(F.struct("category", "product_id", "name"), clicked).alias("click"),
        F.min_by("category", "pos").alias("seen_category"),
    )


def recommend_same_plus_related(
    users: DataFrame,
    interactions: DataFrame,
    products: DataFrame,
    relations: DataFrame,
    as_of: AsOf,
    n: int = 10,
    default_category: str = SHOP_DEFAULT_CATEGORY,
) -> DataFrame:
    """Eight products like the latest click plus one from two related categories.

    Without a click: six of the latest seen category, else of a default one.
    """
    recent = windows.recent_per_user(interactions, products, as_of, days=7)
    profile = users.select("user_id").join(simple_profile(recent), "user_id", "left")
    top = windows.top_products_in_category(products, 10, "newest_id")
    main = F.coalesce("click.category", "seen_category", F.lit(default_category))
    df = look_up(
        profile.withColumn("main_category", main),
        {"main": F.col("main_category")},
        shelf(top, "ids"),
        relations,
        ("main",),
    )
    ids = F.col("main_shelf.ids")
    clicked = F.col("click").isNotNull()
    seen = ~clicked & F.col("seen_category").isNotNull()

    same = blocks(
        clicked,
        block(
            F.array_except(ids, F.array("click.product_id")), 8, "same_category",
            _text("same_category", F.col("click.name")),
        ),
    )
    others = F.filter(
        F.array_distinct("main_related"), lambda e: e["category"] != F.col("main_category")
    )
    related = blocks_of(
        F.when(clicked, others),
        lambda e: block(
            e["ids"], 1, "related_category",
            _text("related_category", F.col("click.name"), e["category"]),
        ),
    )
    viewed = blocks(
        seen, block(ids, 6, "viewed_category", _text("viewed_category", F.col("seen_category")))
    )
    fallback = blocks(
        ~clicked & ~seen, block(ids, 6, "fallback", F.lit(REASONS["fallback"]))
    )
    strategy = (
        F.when(clicked, F.lit("same_category_plus_related"))
        .when(seen, F.lit("view_based_fallback"))
        .otherwise(F.lit("no_data_fallback"))
    )
    return df.select(
        "user_id",
        strategy.alias("strategy_used"),
        "main_category",
        fill(n, same, related, viewed, fallback).alias("recommendations"),
    )


# ------------------------------------------------------------ instant switch


def recommend_instant_switch(
    users: DataFrame,
    interactions: DataFrame,
    products: DataFrame,
    relations: DataFrame,
    as_of: AsOf,
    n: int = 10,
    seed: str | int = 0,
) -> DataFrame:
    """Eight products of the newest clicked or viewed category of the last half
    hour (else the best-scored of the week) and one from two related ones."""
    latest = windows.latest_category(interactions, products, as_of, minutes=30).select(
        "user_id", F.col("category").alias("latest_category")
    )
    recent = windows.recent_per_user(interactions, products, as_of, days=7)
    points = weights.score_of(F.col("interaction_type"), weights.INSTANT)
    weekly = (
        recent.groupBy("user_id", "category")
        .agg(F.sum(points).alias("score"))
        .groupBy("user_id")
        .agg(best_key(F.col("score"), F.col("category")).alias("top_category"))
    )
    profile = (
        users.select("user_id")
        .join(weekly.withColumn("_active", F.lit(True)), "user_id", "left")
        .join(latest, "user_id", "left")
        .withColumn("main_category", F.coalesce("latest_category", "top_category"))
    )
    top = windows.top_products_in_category(products, 10, "seeded", seed=seed)
    df = look_up(profile, {"main": F.col("main_category")}, shelf(top, "ids"), relations, ("main",))
    known = F.col("main_category").isNotNull()
    main = blocks(
        known,
        block(
            F.col("main_shelf.ids"), 8, "main_category",
            _text("main_category", F.col("main_category")),
        ),
    )
    related = blocks_of(
        F.col("main_related"),
        lambda e: block(e["ids"], 1, "related_category", _text("related_short", e["category"])),
    )
    strategy = (
        F.when(known, F.lit("real_data_instant_switch"))
        .when(F.col("_active"), F.lit("no_category"))
        .otherwise(F.lit("no_data"))
    )
    return df.select(
        "user_id",
        strategy.alias("strategy_used"),
        "main_category",
        fill(n, main, related).alias("recommendations"),
    )


# --------------------------------------------------------- recency (8 and 2)


def recency_profile(recent: DataFrame, as_of: AsOf) -> DataFrame:
    """Best clicked category, ordered viewed categories and total score per user."""
    scores = (
        windows.recency_points(recent, as_of)
        .groupBy("user_id", "family", "category")
        .agg(F.sum("tenths").alias("tenths"))
    )
    clicked = F.col("family") == "clicked"
    # At most as many categories as the history cap allows rows.
    viewed = F.collect_list(
        F.when(~clicked, F.struct((-F.col("tenths")).alias("w"), F.col("category").alias("c")))
    )
    return scores.groupBy("user_id").agg(
        F.sum("tenths").alias("total_tenths"),
        best_key(F.when(clicked, F.col("tenths")), F.when(clicked, F.col("category"))).alias(
            "top_clicked"
        ),
        F.array_sort(viewed)["c"].alias("viewed_categories"),
    )


def recommend_recency(
    users: DataFrame,
    interactions: DataFrame,
    products: DataFrame,
    relations: DataFrame,
    history: DataFrame,
    as_of: AsOf,
    seed: str | int = 0,
    n_related: int = 2,
) -> DataFrame:
    """Up to eight products of the main category and two of other categories.

    Main is the newest click or view of five minutes, else the best clicked
    category of the day. The two others come from the user's last ten past
    recommendations, then one per related category, one per viewed category,
    then any other product. ``history(user_id, product_id, category, ts,
    position)`` holds past lists.
    """
    types = (*weights.CLICK_TYPES, *weights.VIEW_TYPES, "recommendation_click")
    latest = windows.latest_category(interactions, products, as_of, minutes=5, types=types).select(
        "user_id", F.col("category").alias("latest_category")
    )
    recent = windows.recent_per_user(interactions, products, as_of, days=1)
    known = products.select("product_id", "category")
    past = (
        windows.bounded_recommendations(history, 10)
        .drop("category")
        .join(known, "product_id")
        .groupBy("user_id")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("rank", "product_id", "category")), asc=False
            ).alias("past")
        )
    )
    profile = (
        users.select("user_id")
        .join(recency_profile(recent, as_of), "user_id", "left")
        .join(latest, "user_id", "left")
        .join(past, "user_id", "left")
        .withColumn("main_category", F.coalesce("latest_category", "top_clicked"))
        .withColumn(
            "_viewed", F.filter("viewed_categories", lambda c: c != F.col("main_category"))
        )
    )
    top = windows.top_products_in_category(products, 10, "seeded", seed=seed)
    # Of three viewed categories at most one can be used up, and two are needed.
    slots = {"main": F.col("main_category")}
    slots |= {f"viewed{k}": F.get("_viewed", F.lit(k)) for k in range(3)}
    # The eight smallest ids, four per category at most, hold four products
    # outside any main category, two more than can be on the list already.
    first_ids = (
        windows.top_products_in_category(products, 4, "oldest_id")
        .orderBy("product_id")
        .limit(8)
        .agg(F.array_sort(F.collect_list(F.struct("product_id", "category"))).alias("f"))
    )
    df = look_up(profile, slots, shelf(top, "ids"), relations, ("main",), n_related)
    df = df.withColumn("_first", first_ids.scalar())
    category = F.col("main_category")
    main_ids = F.slice(F.coalesce("main_shelf.ids", no_ids()), 1, 8)
    scored = F.coalesce(F.col("total_tenths") >= 10, F.lit(False))
    df = df.withColumn("_main_ids", F.when(scored & category.isNotNull(), main_ids))
    ready = F.coalesce(F.size("_main_ids") > 0, F.lit(False))

    main = blocks(
        ready, block(F.col("_main_ids"), 8, "main_category", _text("instant", category))
    )
    foreign = lambda entries: F.filter(entries, lambda e: e["category"] != category)
    single = lambda priority, reason: lambda e: block(
        F.array(e["product_id"]), 1, priority, _text(reason, e["category"])
    )
    history = blocks_of(foreign("past"), single("from_history", "from_history"))
    related = blocks_of(
        F.col("main_related"),
        lambda e: block(e["ids"], 1, "from_related", _text("related_to", category)),
    )
    viewed = [
        block(
            F.col(f"viewed{k}_shelf.ids"), 1, "from_viewed", _text("viewed", F.get("_viewed", F.lit(k)))
        )
        for k in range(3)
    ]
    discovery = blocks_of(foreign("_first"), single("from_discovery", "discovery"))
    others = fill(
        2, history, related, F.array(*viewed).cast(BLOCK_TYPE), discovery, taken=F.col("_main_ids")
    )
    strategy = (
        F.when(~scored, F.lit("no_data_available"))
        .when(category.isNull(), F.lit("no_main_category"))
        .when(~ready, F.lit("no_products_in_category"))
        .otherwise(F.lit("instant_switch_8_plus_2"))
    )
    return df.select(
        "user_id",
        strategy.alias("strategy_used"),
        "main_category",
        F.concat(fill(8, main), F.when(ready, others).otherwise(F.array().cast(PICK_TYPE))).alias(
            "recommendations"
        ),
    )


def recommendation_mix(lists: DataFrame) -> DataFrame:
    """Entries of each list by origin, and whether the main category dominates."""
    origins = ("main_category", "from_related", "from_history", "from_viewed", "from_discovery")
    count = lambda p: F.size(
        F.filter("recommendations", lambda e: e["priority"] == p)
    ).cast("long")
    counts = lists.select("user_id", *[count(p).alias(p) for p in origins])
    return counts.withColumn("main_ok", F.col("main_category") >= 6)


def append_history(history: DataFrame, lists: DataFrame, products: DataFrame, as_of: AsOf) -> DataFrame:
    """Past recommendations plus today's lists, newest fifty per user."""
    rows = lists.select(
        "user_id", F.posexplode("recommendations").alias("position", "entry")
    ).select("user_id", F.col("entry.product_id").alias("product_id"), "position")
    rows = rows.join(products.select("product_id", "category"), "product_id")
    stamped = rows.withColumn("ts", time_literal(history, "ts", as_of)).withColumn("position", F.col("position").cast(history.schema["position"].dataType))
    return windows.bounded_recommendations(history.unionByName(stamped)).drop("rank")
