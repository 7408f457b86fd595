"""Every operator as a query over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.functions import scalars, weights
from clickloom.functions.times import trailing_window
from clickloom.model import EVENT_SCHEMA, PRICE_LABELS
from clickloom.operators import (
    aggregates,
    content,
    dashboards,
    joins,
    lists,
    ml,
    projections,
    windows,
)
from clickloom.plans import batch, explain, hybrid, recommenders, refresh
from clickloom.plans.picks import explode_recommendations
from clickloom.registry import binding as b
from clickloom.registry.binding import AS_OF
from clickloom.sources import events as event_source
from clickloom.sources import keyed, sinks, tables
from clickloom.sources.session import shared_folder
from clickloom.streaming import counters, jobs, refresh_state, session_state, stateful

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SEED = "7"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# ------------------------------------------------------------------ sources


@query
def load_interactions(spark, sf):
    rows = tables.load_interactions(b.interactions(spark, sf), b.products(spark, sf), AS_OF)
    return rows.select("interaction_id", "user_id", "product_id", "category", "price", "product_name")


@query
def load_raw_events(spark, sf):
    raw = b.table(spark, sf, "events").select("event_id", "user_id", "event_type", "props", "ts")
    return tables.load_raw_events(raw, AS_OF)


@query
def read_parquet_table(spark, sf):
    rows = tables.read_parquet_table(spark, f"{sf}/part.parquet", p_type="PROMO")
    return rows.select("p_partkey", "p_name", "p_retailprice")


@query
def parse_events(spark, sf):
    """Events written as JSON text and parsed back."""
    events = b.web_events(spark, sf)
    record = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("event_id"),
            "user_id",
            "event_type",
            "data",
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            "session_id",
        )
    )
    raw = events.select(record.cast("binary").alias("value"))
    return event_source.parse_events(raw).select(
        F.col("event_id").cast("bigint").alias("event_id"),
        "user_id",
        "event_type",
        scalars.product_id_of(F.col("data")).alias("product_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_second"),
    )


# -------------------------------------------------------------- projections


@query
def score_preference(spark, sf):
    rows = projections.with_score(b.shop_interactions(spark, sf), weights.PREFERENCE)
    return rows.select("interaction_id", "score")


@query
def score_trending(spark, sf):
    rows = projections.with_score(b.shop_interactions(spark, sf), weights.TRENDING)
    return rows.select("interaction_id", "score")


@query
def score_engagement(spark, sf):
    rows = projections.with_score(b.interactions(spark, sf), weights.ENGAGEMENT)
    return rows.select("interaction_id", "score")


@query
def score_cascade(spark, sf):
    rows = projections.with_cascade_family(b.shop_interactions(spark, sf))
    return rows.select("interaction_id", "family", "score")


@query
def score_simple(spark, sf):
    rows = projections.with_simple_family(b.shop_interactions(spark, sf))
    return rows.select("interaction_id", "family", "score")


@query
def score_instant(spark, sf):
    rows = projections.with_score(b.shop_interactions(spark, sf), weights.INSTANT)
    return rows.select("interaction_id", "score")


@query
def score_recency(spark, sf):
    recent = windows.recent_per_user(
        b.shop_interactions(spark, sf), b.products(spark, sf), AS_OF, days=1
    )
    rows = windows.recency_points(recent, AS_OF)
    return rows.select(
        "interaction_id", "family", (F.col("tenths") / 10).alias("score")
    )


@query
def time_columns(spark, sf):
    rows = projections.with_time_columns(b.interactions(spark, sf))
    return rows.select("interaction_id", "hour_of_day", "day_of_week")


@query
def price_band(spark, sf):
    rows = projections.with_price_band(
        b.products(spark, sf), "price", b.PRICE_EDGES, PRICE_LABELS
    )
    return rows.select("product_id", "price_band")


@query
def trailing_24h(spark, sf):
    rows = trailing_window(b.interactions(spark, sf), AS_OF, hours=24)
    return rows.select("interaction_id", "user_id", "ts")


@query
def important_events(spark, sf):
    rows = projections.important_events(b.web_events(spark, sf))
    return rows.select("event_id", "user_id", "event_type")


@query
def click_like(spark, sf):
    rows = b.shop_interactions(spark, sf).filter(
        projections.click_like(F.col("interaction_type"))
    )
    return rows.select("interaction_id", "interaction_type")


@query
def complete_pairs(spark, sf):
    rows = projections.complete_pairs(b.shop_interactions(spark, sf))
    return rows.select("interaction_id", "user_id", "product_id")


@query
def product_search(spark, sf):
    rows = projections.product_search(b.products(spark, sf), "RING", "PROMO")
    return rows.select("product_id", "name", "category")


@query
def document_search(spark, sf):
    """The same search over the whole texts of the documents."""
    texts = b.table(spark, sf, "documents").select(
        F.col("doc_id").alias("product_id"), F.col("text").alias("name"),
        F.col("lang").alias("category"),
    )
    return projections.product_search(texts, "The", "en").select("product_id", "category")


@query
def browse_category(spark, sf):
    rows = projections.browse_category(b.products(spark, sf), "PROMO", page=2)
    return rows.select("product_id", "name", "total")


@query
def normalise_event_type(spark, sf):
    rows = projections.normalise_event_type(b.web_events(spark, sf))
    return rows.select("event_id", "raw_type", "normalised_type")


@query
def to_interaction(spark, sf):
    rows = projections.to_interaction(b.web_events(spark, sf))
    return rows.select("event_id", "user_id", "product_id", "interaction_type", "ts")


@query
def extract_product_id(spark, sf):
    return projections.extract_product_id(b.web_events(spark, sf)).select("event_id", "product_id")


@query
def parse_details(spark, sf):
    rows = projections.parse_details(b.shop_interactions(spark, sf))
    return rows.select("interaction_id", "detail_action", "detail_query")


@query
def hydrate_ranked(spark, sf):
    """Each user's newest products as a ranked id list, turned into product rows."""
    recent = windows.recent_per_user(
        b.shop_interactions(spark, sf), b.products(spark, sf), AS_OF, days=7, n=10
    )
    ids = recent.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "product_id")))["product_id"].alias("product_ids")
    )
    rows = projections.hydrate_ranked(ids, b.products(spark, sf))
    return rows.select("user_id", "rank", "product_id", "name", "category")


@query
def lookup_product(spark, sf):
    return projections.lookup_product(b.products(spark, sf), 42).select(
        "product_id", "name", "category", "price"
    )


# -------------------------------------------------------------------- joins


@query
def interactions_inner_product(spark, sf):
    rows = joins.interactions_inner_product(b.shop_interactions(spark, sf), b.products(spark, sf))
    return rows.select("interaction_id", "product_id", "name", "category")


@query
def interactions_left_product(spark, sf):
    rows = joins.interactions_left_product(b.shop_interactions(spark, sf), b.products(spark, sf))
    return rows.select("interaction_id", "product_id", "name", "category")


@query
def products_left_recent(spark, sf):
    rows = joins.products_left_recent(b.products(spark, sf), b.interactions(spark, sf), AS_OF, 7)
    return rows.select("product_id", "name", "interaction_count")


@query
def products_left_recent_where(spark, sf):
    rows = joins.products_left_recent_where(
        b.products(spark, sf), b.interactions(spark, sf), AS_OF, 1
    )
    return rows.select("product_id", "name", "interaction_count")


@query
def users_left_interactions(spark, sf):
    rows = joins.users_left_interactions(b.users(spark, sf), b.interactions(spark, sf))
    return rows.select("user_id", "username", "interaction_id", "interaction_type")


@query
def interactions_user_product(spark, sf):
    rows = joins.interactions_user_product(
        b.shop_interactions(spark, sf), b.users(spark, sf), b.products(spark, sf)
    )
    return rows.select("interaction_id", "username", "product_name")


@query
def exclude_ids(spark, sf):
    rows = b.interactions(spark, sf)
    seen = rows.filter(F.col("interaction_type") == "purchase")
    pairs = rows.select("user_id", "product_id").distinct()
    return joins.exclude_ids(pairs, seen, ["user_id", "product_id"])


@query
def in_ids(spark, sf):
    bought = b.interactions(spark, sf).filter(F.col("interaction_type") == "purchase")
    return joins.in_ids(b.products(spark, sf), bought).select("product_id", "name")


@query
def related_categories(spark, sf):
    scores = aggregates.category_preferences(b.interactions(spark, sf), b.products(spark, sf))
    best = windows.top_category(scores, 1, "category_score").select("user_id", "category")
    return joins.related_categories(best, b.relations(spark, sf), 2)


@query
def similar_products(spark, sf):
    liked = aggregates.favourite_products(b.interactions(spark, sf), 5)
    rows = joins.similar_products(liked, b.products(spark, sf), 3, 5)
    return rows.select("user_id", "rank", "product_id", "category")


@query
def scalar_total(spark, sf):
    counts = aggregates.counts_by_type(b.interactions(spark, sf))
    return joins.with_scalar_total(counts, b.users(spark, sf), "all_users")


# --------------------------------------------------------------- aggregates


@query
def user_product_scores(spark, sf):
    return aggregates.user_product_scores(b.shop_interactions(spark, sf), b.products(spark, sf))


@query
def category_preferences(spark, sf):
    return aggregates.category_preferences(b.shop_interactions(spark, sf), b.products(spark, sf))


@query
def purchase_preferences(spark, sf):
    """Category preferences over the order lines, the larger fact table."""
    return aggregates.category_preferences(b.purchases(spark, sf), b.products(spark, sf))


@query
def trending_products(spark, sf):
    return aggregates.trending_products(
        b.shop_interactions(spark, sf), b.products(spark, sf), AS_OF
    )


@query
def user_segments_rule(spark, sf):
    recent = trailing_window(b.interactions(spark, sf), AS_OF, days=7)
    return aggregates.user_segments_rule(recent, b.products(spark, sf))


@query
def user_features(spark, sf):
    return aggregates.user_features(b.shop_interactions(spark, sf), b.products(spark, sf), AS_OF)


@query
def implicit_ratings(spark, sf):
    rows = aggregates.implicit_ratings(b.interactions(spark, sf))
    return rows.withColumn("rating", F.round("rating", 6))


@query
def top_products_stats(spark, sf):
    return dashboards.top_products_stats(b.products(spark, sf), b.interactions(spark, sf), AS_OF)


@query
def user_activity_summary(spark, sf):
    return aggregates.user_activity_summary(
        b.shop_interactions(spark, sf), b.products(spark, sf), AS_OF
    )


@query
def category_product_counts(spark, sf):
    return aggregates.category_product_counts(b.products(spark, sf), b.interactions(spark, sf))


@query
def category_counts(spark, sf):
    return aggregates.category_counts(b.products(spark, sf), b.interactions(spark, sf))


@query
def activity_timeline(spark, sf):
    return dashboards.activity_timeline(b.interactions(spark, sf), AS_OF)


@query
def activity_timeline_hourly(spark, sf):
    """A clock two days later leaves the last hours empty: the hourly form."""
    return dashboards.activity_timeline(b.interactions(spark, sf), "2024-02-02 00:00:00")


@query
def category_performance(spark, sf):
    return dashboards.category_performance(
        b.products(spark, sf), b.shop_interactions(spark, sf), b.users(spark, sf)
    )


@query
def volume_segments(spark, sf):
    return dashboards.volume_segments(b.interactions(spark, sf))


@query
def live_metrics(spark, sf):
    return dashboards.live_metrics(b.interactions(spark, sf), AS_OF)


@query
def active_sessions(spark, sf):
    sessions = stateful.session_activity(b.heartbeats(spark, sf))
    return dashboards.active_sessions(sessions, AS_OF, minutes=60)


@query
def active_session_count(spark, sf):
    sessions = stateful.session_activity(b.heartbeats(spark, sf))
    return dashboards.active_session_count(sessions, AS_OF)


@query
def active_sessions_by_user(spark, sf):
    sessions = stateful.session_activity(b.heartbeats(spark, sf))
    return dashboards.active_sessions_by_user(sessions, AS_OF, minutes=60)


@query
def hourly_by_type(spark, sf):
    return dashboards.hourly_by_type(b.interactions(spark, sf))


@query
def top_categories(spark, sf):
    feed = trailing_window(b.interactions(spark, sf), AS_OF, hours=24)
    return dashboards.top_categories(feed, b.products(spark, sf))


@query
def headline_stats(spark, sf):
    return dashboards.headline_stats(b.interactions(spark, sf), b.products(spark, sf), AS_OF)


@query
def latest_bucket(spark, sf):
    return dashboards.latest_bucket(dashboards.activity_timeline(b.interactions(spark, sf), AS_OF))


@query
def counts_by_type(spark, sf):
    return aggregates.counts_by_type(b.interactions(spark, sf))


@query
def top_users(spark, sf):
    return aggregates.top_users(b.interactions(spark, sf), b.users(spark, sf))


@query
def user_type_counts(spark, sf):
    return aggregates.user_type_counts(b.interactions(spark, sf))


@query
def user_type_matrix(spark, sf):
    return aggregates.user_type_matrix(b.users(spark, sf), b.shop_interactions(spark, sf))


@query
def category_sizes(spark, sf):
    return aggregates.category_sizes(b.products(spark, sf))


@query
def table_totals(spark, sf):
    return dashboards.table_totals(
        b.interactions(spark, sf), b.products(spark, sf), b.users(spark, sf), AS_OF
    )


@query
def product_counters(spark, sf):
    return aggregates.product_counters(b.interactions(spark, sf))


@query
def user_profile_counters(spark, sf):
    return aggregates.user_profile_counters(b.web_events(spark, sf), b.PRICE_EDGES)


@query
def recommendation_clicks(spark, sf):
    return aggregates.recommendation_clicks(b.web_events(spark, sf))


@query
def shopping_patterns(spark, sf):
    return aggregates.shopping_patterns(b.shop_interactions(spark, sf))


@query
def favourite_products(spark, sf):
    return aggregates.favourite_products(b.interactions(spark, sf))


@query
def user_event_lists(spark, sf):
    rows = windows.user_event_lists(b.web_events(spark, sf), chunk=20)
    return rows.select(
        "user_id",
        "part",
        F.array_join("event_types", ",").alias("event_types"),
        F.array_join(
            F.transform("event_data", lambda d: F.coalesce(d["product_id"], F.lit("-"))), ","
        ).alias("products"),
    )


@query
def user_interests(spark, sf):
    return aggregates.user_interests(b.web_events(spark, sf), b.PRICE_EDGES)


@query
def user_totals(spark, sf):
    return aggregates.user_totals(b.users(spark, sf), b.interactions(spark, sf))


# ------------------------------------------------------- ranking and windows


@query
def recent_per_user(spark, sf):
    rows = windows.recent_per_user(
        b.shop_interactions(spark, sf), b.products(spark, sf), AS_OF, days=7, n=10
    )
    return rows.select("user_id", "pos", "interaction_id", "product_id", "category", "price")


@query
def recent_per_user_published(spark, sf):
    """The published cap of a hundred interactions."""
    rows = windows.recent_per_user(b.shop_interactions(spark, sf), b.products(spark, sf), AS_OF, days=7)
    return rows.select("user_id", "pos", "interaction_id", "product_id", "category", "price")


@query
def latest_category(spark, sf):
    return windows.latest_category(
        b.shop_interactions(spark, sf), b.products(spark, sf), AS_OF, minutes=1440
    )


@query
def history_recent_views(spark, sf):
    return windows.bounded_history(b.web_events(spark, sf), "recent_views", 5)


@query
def history_searches(spark, sf):
    return windows.bounded_history(b.web_events(spark, sf), "search_history", 5)


@query
def history_page_views(spark, sf):
    return windows.bounded_history(b.web_events(spark, sf), "page_views", 5)


@query
def history_recommendations(spark, sf):
    return windows.bounded_recommendations(b.past_recommendations(spark, sf), 10)


@query
def history_recent_views_published(spark, sf):
    return windows.bounded_history(b.web_events(spark, sf), "recent_views")


@query
def history_searches_published(spark, sf):
    return windows.bounded_history(b.web_events(spark, sf), "search_history")


@query
def history_page_views_published(spark, sf):
    return windows.bounded_history(b.web_events(spark, sf), "page_views")


@query
def history_recommendations_published(spark, sf):
    return windows.bounded_recommendations(b.past_recommendations(spark, sf))


@query
def recency_weighted_scores(spark, sf):
    return windows.recency_weighted_scores(
        b.shop_interactions(spark, sf), b.products(spark, sf), AS_OF
    )


@query
def top_category(spark, sf):
    scores = windows.recency_weighted_scores(
        b.shop_interactions(spark, sf), b.products(spark, sf), AS_OF
    ).filter(F.col("family") == "clicked")
    return windows.top_category(scores, 2).select("user_id", "rank", "category", "score")


@query
def top_products_trend(spark, sf):
    rows = windows.top_products_in_category(
        b.products(spark, sf), 10, "trend", interactions=b.interactions(spark, sf), as_of=AS_OF
    )
    return rows.select("category", "rank", "product_id", "interaction_count")


@query
def top_products_newest(spark, sf):
    rows = windows.top_products_in_category(b.products(spark, sf), 10, "newest_id")
    return rows.select("category", "rank", "product_id")


@query
def top_products_seeded(spark, sf):
    rows = windows.top_products_in_category(b.products(spark, sf), 10, "seeded", seed=SEED)
    return rows.select("category", "rank", "product_id")


@query
def global_trending(spark, sf):
    rows = windows.global_trending(
        b.products(spark, sf), b.interactions(spark, sf), AS_OF, 20, SEED
    )
    return rows.select("product_id", "name", "interaction_count")


@query
def recent_activity_feed(spark, sf):
    rows = windows.recent_activity_feed(
        b.shop_interactions(spark, sf), b.users(spark, sf), b.products(spark, sf), 20
    )
    return rows.select("interaction_id", "username", "product_name", "interaction_type", "ts")


@query
def first_products(spark, sf):
    return windows.first_products(b.products(spark, sf)).select("product_id", "name", "price")


@query
def user_history(spark, sf):
    rows = windows.user_history(b.shop_interactions(spark, sf), b.products(spark, sf), AS_OF)
    return rows.select("user_id", "interaction_id", "interaction_type", "name", "ts")


@query
def window_feed(spark, sf):
    rows = windows.window_feed(
        b.shop_interactions(spark, sf), b.products(spark, sf), AS_OF, min_rows=10
    )
    return rows.select("interaction_id", "interaction_type", "category", "price", "ts")


# --------------------------------------------------------------------- lists


@query
def merge_ranked(spark, sf):
    """Newest products before the most viewed ones, per user."""
    recent = windows.recent_per_user(
        b.interactions(spark, sf), b.products(spark, sf), AS_OF, days=7, n=10
    )
    new = recent.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "product_id")))["product_id"].alias("new")
    )
    liked = aggregates.favourite_products(b.interactions(spark, sf), 10)
    cur = liked.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "product_id")))["product_id"].alias("cur")
    )
    both = new.join(cur, "user_id", "full")
    merged = both.select("user_id", lists.merge_ranked(F.col("new"), F.col("cur")).alias("ids"))
    return merged.select("user_id", F.posexplode("ids").alias("_p", "product_id")).select(
        "user_id", (F.col("_p") + 1).cast("int").alias("rank"), "product_id"
    )


def _last_day(spark, sf):
    return trailing_window(b.web_events(spark, sf), AS_OF, days=1)


def _shelf(spark, sf):
    return refresh.category_top(b.products(spark, sf), b.interactions(spark, sf), AS_OF)


def _trending(spark, sf):
    return refresh.trending_ranks(
        aggregates.trending_products(b.interactions(spark, sf), b.products(spark, sf), AS_OF)
    )


@query
def candidate_union(spark, sf):
    events = projections.important_events(_last_day(spark, sf))
    interests = aggregates.user_interests(events)
    kind = F.col("kind")
    return lists.candidate_union(
        events.select("user_id").distinct(),
        interests.filter(kind == "category").select(
            "user_id", F.col("value").alias("category"), "count"
        ),
        interests.filter(kind == "recent_product").select(
            "user_id", F.col("value").cast("bigint").alias("product_id")
        ),
        _trending(spark, sf),
        _shelf(spark, sf),
    )


@query
def distinct_values(spark, sf):
    return lists.distinct_values(b.shop_interactions(spark, sf), "user_id", "interaction_type")


@query
def drop_matching_sessions(spark, sf):
    sessions = stateful.session_activity(b.heartbeats(spark, sf))
    rows = lists.drop_matching_sessions(sessions, "tab_1", AS_OF, minutes=1440)
    return rows.select("session_id", "user_id", "last_activity")


# ------------------------------------------------------------------------ ml


def _ratings(spark, sf):
    return batch.preference_ratings(b.shop_interactions(spark, sf), b.products(spark, sf))


@query
def train_als(spark, sf):
    """Predictions of the held-out pairs by a trained model."""
    ratings, _ = ml.model_ids(_ratings(spark, sf))
    parts = ml.split_ratings(ratings)
    model = ml.train_als(parts.train)
    return model.transform(parts.test).select("user_id", "product_id", "rating", "prediction")


@query
def tuned_als(spark, sf):
    """The settings of a small grid and which one has the least validation error."""
    ratings, _ = ml.model_ids(_ratings(spark, sf))
    parts = ml.split_ratings(ratings, validation=0.2)
    grid = ((2, 3, 0.5), (4, 3, 0.1), (4, 5, 0.1))
    found = ml.als_grid(parts.train, parts.validation, grid)
    least = min(rmse for _, _, rmse in found)
    rows = [(k, *setting, 0 < rmse < 1e6, rmse == least) for k, (setting, _, rmse) in enumerate(found)]
    table = spark.createDataFrame(rows, "number int, rank int, iterations int, regularisation double, scored boolean, chosen boolean")
    chosen = F.min(F.when(F.col("chosen"), F.col("number")))
    return table.agg(
        F.count("*").alias("settings"), F.bool_and("scored").alias("all_scored"),
        F.count_if("chosen").alias("chosen"), chosen.isNotNull().alias("has_choice"),
        F.sum("rank").alias("ranks"), F.round(F.sum("regularisation"), 6).alias("regularisations"),
    )


@query
def saved_model(spark, sf):
    """A model written and read again predicts the same for every pair."""
    ratings, _ = ml.model_ids(_ratings(spark, sf))
    model = ml.train_als(ratings, rank=4, iterations=3)
    path = shared_folder(spark, "model")
    sinks.save_model(model, path)
    again = sinks.load_als(path).transform(ratings).select("user_id", "product_id", F.col("prediction").alias("again"))
    both = model.transform(ratings).join(again, ["user_id", "product_id"])
    return both.agg(F.count("*").alias("pairs"), F.count_if(F.col("prediction") == F.col("again")).alias("same"))


@query
def list_rank(spark, sf):
    """Entries of the favourite lists with their places."""
    liked = aggregates.favourite_products(b.interactions(spark, sf), 5)
    entry = F.struct("rank", "product_id", "interaction_count")
    lists = liked.groupBy("user_id").agg(F.array_sort(F.collect_list(entry)).alias("_l"))
    fields = F.transform("_l", lambda e: F.struct(e["product_id"].alias("product_id"), e["interaction_count"].alias("interaction_count")))
    return windows.list_rank(lists.select("user_id", fields.alias("recommendations")))


@query
def write_partitioned(spark, sf):
    """Products written by category, twice, and the folders read one by one."""
    path = shared_folder(spark, "products")
    for _ in range(2):
        sinks.write_partitioned(b.products(spark, sf), path)
    return spark.read.parquet(path).select("product_id", "name", "category", "price")


@query
def write_snapshot(spark, sf):
    path = shared_folder(spark, "trending")
    rows = aggregates.trending_products(b.shop_interactions(spark, sf), b.products(spark, sf), AS_OF)
    for _ in range(2):
        sinks.write_snapshot(rows, path)
    return spark.read.parquet(path)


@query
def write_json(spark, sf):
    """Rule segments as JSON documents, read back by their schema."""
    path = shared_folder(spark, "segments")
    rows = b.products(spark, sf).groupBy("category").agg(
        F.count("*").alias("products"), F.sort_array(F.collect_set("name")).alias("names")
    )
    sinks.write_json(rows, path)
    stored = tables.load_json_results(spark, path, "category string, products bigint, names array<string>")
    return stored.select("category", "products", F.array_join("names", ",").alias("names"))


@query
def import_relational(spark, sf):
    """A table copied and counted on both sides."""
    path = shared_folder(spark, "customers")
    written = tables.import_relational(b.users(spark, sf), path)
    return spark.read.parquet(path).withColumn("rows_written", F.lit(written).cast("bigint"))


@query
def append_interactions(spark, sf):
    """Two batches of interactions, the first one written twice."""
    path = shared_folder(spark, "interactions")
    rows = projections.to_interaction(b.web_events(spark, sf))
    halves = [rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")]
    for number, half in ((0, halves[0]), (1, halves[1]), (0, halves[0])):
        sinks.append_interactions(half, path, number, "query")
    stored = spark.read.parquet(path)
    return stored.select("event_id", "user_id", "product_id", "interaction_type", "ts", F.col("batch_id").cast("bigint").alias("batch"))


@query
def recommend_for_all(spark, sf):
    ratings, labels = ml.model_ids(_ratings(spark, sf))
    model = ml.train_als(ml.split_ratings(ratings).train)
    rows = windows.list_rank(
        ml.recommend_for_all(model, labels, AS_OF).select("user_id", "recommendations")
        .withColumn("recommendations", F.transform(
            "recommendations",
            lambda e: F.struct(e["product_id"].alias("product_id"),
                               e["predicted_rating"].alias("predicted_rating")))),
    )
    return rows.select("user_id", "rank", "product_id", "predicted_rating")


def _predictions(spark, sf):
    """Ratings with a plain stand-in for a model's prediction, absent for pairs
    seen once."""
    rows = aggregates.implicit_ratings(b.interactions(spark, sf))
    guess = F.when(F.col("interaction_count") > 1, F.col("total_score") / 2.0)
    return rows.withColumn("prediction", guess)


@query
def regression_metrics(spark, sf):
    rows = ml.regression_metrics(_predictions(spark, sf))
    return rows.select(
        F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"), "total_predictions"
    )


@query
def coverage(spark, sf):
    rows = _predictions(spark, sf)
    return ml.coverage(rows, rows)


@query
def kmeans_clusters(spark, sf):
    """Cluster of each user under the k of best silhouette."""
    features = aggregates.user_features(
        b.interactions(spark, sf), b.products(spark, sf), AS_OF, ordered=False
    )
    scaled, _ = ml.assemble_scale(features.select("user_id", *ml.FEATURES))
    model, _ = ml.kmeans_select_k(scaled)
    return model.transform(scaled).select("user_id", "prediction")


@query
def kmeans_properties(spark, sf):
    """What holds of any right clustering: all users, 2 to 7 clusters, the best silhouette."""
    features = aggregates.user_features(
        b.interactions(spark, sf), b.products(spark, sf), AS_OF, ordered=False
    )
    scaled, _ = ml.assemble_scale(features.select("user_id", *ml.FEATURES))
    model, scores = ml.kmeans_select_k(scaled)
    found = model.transform(scaled).groupBy("prediction").agg(F.count("*").alias("n"))
    k = len(model.clusterCenters())
    return found.agg(
        F.sum("n").alias("users"),
        (F.lit(sorted(scores) == list(ml.CLUSTER_RANGE)) & F.lit(k in ml.CLUSTER_RANGE)).alias("k_in_range"),
        F.lit(scores[k] == max(scores.values())).alias("best_silhouette"),
        (F.count("*") == k).alias("all_used"),
    )


@query
def silhouette_by_k(spark, sf):
    """Silhouettes of 2 to 7 equally wide bands of activity over the standardised features."""
    features = aggregates.user_features(
        b.interactions(spark, sf), b.products(spark, sf), AS_OF, ordered=False
    )
    scaled, _ = ml.assemble_scale(features)
    top = scaled.agg(F.max("total_interactions")).scalar()
    rows = scaled.select(
        F.col("total_interactions").cast("bigint").alias("total"),
        top.cast("bigint").alias("top"),
        vector_to_array("features").alias("features"),
        F.explode(F.array(*[F.lit(k) for k in ml.CLUSTER_RANGE])).alias("k"),
    )
    rows = rows.select("k", F.expr("total * k div (top + 1)").alias("cluster"), "features")
    found = ml.silhouettes(rows).withColumn("mean_silhouette", F.round("mean_silhouette", 6))
    best = found.agg(F.max_by("k", F.struct("mean_silhouette", -F.col("k")))).scalar()
    return found.select(
        "k",
        "cluster",
        "users",
        F.round("silhouette", 6).alias("silhouette"),
        "mean_silhouette",
        (F.col("k") == best).alias("chosen"),
    )


@query
def assemble_scale(spark, sf):
    """Standardised features of each user."""
    features = aggregates.user_features(
        b.interactions(spark, sf), b.products(spark, sf), AS_OF, ordered=False
    )
    scaled, _ = ml.assemble_scale(features)
    values = vector_to_array("features")
    return scaled.select("user_id", *[F.round(values[k], 6).alias(c) for k, c in enumerate(ml.FEATURES)])


@query
def index_ids(spark, sf):
    """Dense index of each user with a rating."""
    _, labels = ml.index_ids(aggregates.implicit_ratings(b.interactions(spark, sf)))
    return labels["user_id"].select("user_id", "user_index")


@query
def index_to_label(spark, sf):
    """Indices of the rated pairs and back to ids."""
    ratings, labels = ml.index_ids(aggregates.implicit_ratings(b.interactions(spark, sf)))
    rows = ratings.select("user_index", "product_index", "interaction_count")
    return ml.index_to_label(rows, labels).select("user_id", "product_id", "interaction_count")


@query
def als_properties(spark, sf):
    """What holds of any right model: all rated pairs predicted, lists dense, distinct, in order."""
    ratings, labels = ml.model_ids(_ratings(spark, sf).where("product_id is not null"))
    model = ml.train_als(ratings)
    done = model.transform(ratings).agg(
        F.count("*").alias("n"), F.count_if(~F.isnan("prediction")).alias("good")
    )
    lists = ml.recommend_for_all(model, labels, AS_OF)
    entries = F.col("recommendations")
    ranks = F.transform(entries, lambda e: e["rank"])
    rating = F.transform(entries, lambda e: e["predicted_rating"])
    products = F.transform(entries, lambda e: e["product_id"])
    checked = lists.agg(
        F.count("*").alias("users"),
        F.sum(F.size(entries)).cast("bigint").alias("entries"),
        F.every(ranks == F.sequence(F.lit(1), F.size(entries))).alias("ranks_dense"),
        F.every(rating == F.sort_array(rating, asc=False)).alias("ratings_in_order"),
        F.every(F.size(F.array_distinct(products)) == F.size(entries)).alias("products_distinct"),
    )
    counts = done.agg(F.first(F.struct("n", "good")).alias("c")).scalar()
    return checked.select(
        counts["n"].alias("pairs"), (counts["n"] == counts["good"]).alias("all_predicted"), "*"
    )


def _banded(spark, sf):
    """Features with a volume band in place of a fitted cluster."""
    features = aggregates.user_features(
        b.interactions(spark, sf), b.products(spark, sf), AS_OF, ordered=False
    )
    band = F.when(F.col("total_interactions") >= 70, 0).when(F.col("total_interactions") >= 60, 1)
    return features.withColumn("prediction", band.otherwise(2))


@query
def cluster_profile(spark, sf):
    rows = ml.cluster_profile(_banded(spark, sf))
    best = F.get("top_categories", F.lit(0))
    return rows.select(
        "prediction",
        "cluster_size",
        *[
            F.round(c, 6).alias(c)
            for c in ("avg_interactions", "avg_engagement", "avg_unique_products", "avg_price_preference")
        ],
        best["category"].alias("top_category"),
        best["users"].alias("top_category_users"),
    )


@query
def label_clusters(spark, sf):
    rows = ml.label_clusters(
        ml.cluster_profile(_banded(spark, sf)), power=(170, 60), explorer=(140, 40), premium=904
    )
    return rows.select("cluster", "type", "size", "marketing_strategy")


@query
def hybrid_blend(spark, sf):
    """Four behaviour scores blended with the published weights."""
    rows = b.shop_interactions(spark, sf)
    goods = b.products(spark, sf)
    ratings = aggregates.implicit_ratings(rows).select(
        "user_id", "product_id", F.round("rating", 6).alias("score"), F.lit("cf").alias("source")
    )
    pairs = aggregates.user_product_scores(rows, goods)
    liking = aggregates.category_preferences(rows, goods)
    content_scores = pairs.join(liking, ["user_id", "category"]).select(
        "user_id", "product_id", F.col("category_score").cast("double").alias("score"),
        F.lit("content").alias("source"),
    )
    popular = pairs.join(joins.product_counts(rows), "product_id").select(
        "user_id", "product_id", F.col("interaction_count").cast("double").alias("score"),
        F.lit("popularity").alias("source"),
    )
    behaviour = pairs.select(
        "user_id", "product_id", F.col("total_score").cast("double").alias("score"),
        F.lit("behavior").alias("source"),
    )
    scores = ratings.unionByName(content_scores).unionByName(popular).unionByName(behaviour)
    return ml.hybrid_blend(scores).withColumn("score", F.round("score", 6))


@query
def hybrid_sources(spark, sf):
    """The deterministic scores of the hybrid recommender; popularity has no user."""
    goods = b.products(spark, sf)
    similar = content.content_similarity(goods, 5)
    rows = hybrid.sources(b.shop_interactions(spark, sf), goods, similar)
    return rows.select("user_id", "product_id", "source", "score")


@query
def recommend_hybrid(spark, sf):
    """Lists blended of ALS, content, popularity and behaviour: their form."""
    rows = hybrid.recommend_hybrid(b.shop_interactions(spark, sf), b.products(spark, sf))
    per_user = rows.groupBy("user_id").agg(
        F.count("*").alias("entries"),
        (F.max("rank") == F.count("*")).alias("ranks_dense"),
        (F.count_distinct("product_id") == F.count("*")).alias("products_distinct"),
        ((F.min("score") > 0) & (F.max("score") <= 1.000001)).alias("scores_in_range"),
    )
    return per_user.select("user_id", "entries", "ranks_dense", "products_distinct", "scores_in_range")


@query
def recommend_hybrid_lists(spark, sf):
    """The lists themselves, with predictions that SQL can form: shares of the interaction types."""
    rows, goods = b.shop_interactions(spark, sf), b.products(spark, sf)
    types = b.PREDICTED_TYPES

    def factors(key):
        counts = [F.count_if(F.col("interaction_type") == t) for t in types]
        shares = F.array(*(F.round(c / F.count("*"), 4) for c in counts))
        return rows.where(f"{key} is not null").groupBy(key).agg(shares.alias("features"))

    lists = hybrid.recommend_hybrid(rows, goods, 10, factors=(factors("user_id"), factors("product_id")))
    return lists.select("user_id", "rank", "product_id", F.round("score", 6).alias("score"))


@query
def content_similarity(spark, sf):
    return content.content_similarity(b.products(spark, sf), 5)


@query
def content_similarity_texts(spark, sf):
    """The same over texts with a large vocabulary, in two categories."""
    texts = b.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("product_id"),
        F.col("text").alias("name"),
        F.lit(None).cast("string").alias("description"),
        F.when(F.col("item_id") % 2 == 0, "even").otherwise("odd").alias("category"),
    )
    return content.content_similarity(texts, 5)


# -------------------------------------------------------------- recommenders


def _rows(recs, spark, sf):
    rows = explode_recommendations(recs, b.products(spark, sf))
    return rows.select(
        "user_id", "rank", "product_id", "name", "category", "price", "reason", "priority",
        "strategy_used",
    )


def _cascade(spark, sf):
    return recommenders.recommend_cascade(
        b.users(spark, sf), b.shop_interactions(spark, sf), b.products(spark, sf),
        b.relations(spark, sf), AS_OF, seed=SEED,
    )


def _same_plus_related(spark, sf):
    return recommenders.recommend_same_plus_related(
        b.users(spark, sf), b.shop_interactions(spark, sf), b.products(spark, sf),
        b.relations(spark, sf), AS_OF, default_category=b.DEFAULT_CATEGORY,
    )


def _instant(spark, sf):
    return recommenders.recommend_instant_switch(
        b.users(spark, sf), b.shop_interactions(spark, sf), b.products(spark, sf),
        b.relations(spark, sf), AS_OF, seed=SEED,
    )


def _recency(spark, sf):
    return recommenders.recommend_recency(
        b.users(spark, sf), b.shop_interactions(spark, sf), b.products(spark, sf),
        b.relations(spark, sf), b.past_recommendations(spark, sf), AS_OF, seed=SEED,
    )


@query
def recommend_cascade(spark, sf):
    return _rows(_cascade(spark, sf), spark, sf)


@query
def recommend_same_plus_related(spark, sf):
    return _rows(_same_plus_related(spark, sf), spark, sf)


@query
def recommend_instant_switch(spark, sf):
    return _rows(_instant(spark, sf), spark, sf)


@query
def recommend_recency_8_2(spark, sf):
    return _rows(_recency(spark, sf), spark, sf)


@query
def recommendation_mix(spark, sf):
    return recommenders.recommendation_mix(_recency(spark, sf))


@query
def recommendation_strategies(spark, sf):
    """Strategy and list length of every user under each recommender."""
    parts = [
        recs(spark, sf).select(
            F.lit(name).alias("recommender"), "user_id", "strategy_used",
            F.size("recommendations").alias("total"),
        )
        for name, recs in (
            ("cascade", _cascade), ("same_plus_related", _same_plus_related),
            ("instant_switch", _instant), ("recency_8_2", _recency),
        )
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def refresh_recommendations(spark, sf):
    """Stored lists (most viewed products) refreshed by the last day's events."""
    liked = aggregates.favourite_products(b.interactions(spark, sf), 10)
    stored = liked.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "product_id")))["product_id"].alias("product_ids")
    )
    fresh = refresh.refresh_recommendations(
        _last_day(spark, sf), stored, _trending(spark, sf), _shelf(spark, sf)
    )
    return fresh.select("user_id", F.posexplode("product_ids").alias("_p", "product_id")).select(
        "user_id", (F.col("_p") + 1).cast("int").alias("rank"), "product_id"
    )


def _recent(spark, sf):
    return windows.recent_per_user(
        b.shop_interactions(spark, sf), b.products(spark, sf), AS_OF, days=7
    )


@query
def explain_recommendations(spark, sf):
    rows = explain.explain_recommendations(_same_plus_related(spark, sf), _recent(spark, sf))
    entries = lambda c: F.array_join(
        F.transform(c, lambda e: F.concat(e["category"], F.lit(":"), e["score"].cast("string"))), ","
    )
    return rows.select(
        "user_id", "strategy_used", "total", "recent_clicks_count", "recent_interactions_count",
        "total_interactions", "latest_click_category", "latest_click_product",
        "latest_interaction_category",
        entries("top_clicked_categories").alias("top_clicked"),
        entries("top_viewed_categories").alias("top_viewed"),
    )


@query
def behaviour_profile(spark, sf):
    rows = explain.behaviour_profile(_recent(spark, sf))
    entries = lambda c: F.array_join(
        F.transform(c, lambda e: F.concat(e["category"], F.lit(":"), e["score"].cast("string"))), ","
    )
    return rows.select(
        "user_id", "recent_clicks_count", "recent_views_count",
        entries("clicked_categories").alias("clicked"),
        entries("viewed_categories").alias("viewed"),
        entries("searched_categories").alias("searched"),
        F.array_join(F.transform("favorite_products", lambda p: p.cast("string")), ",").alias("favourites"),
    )


# ----------------------------------------------------------------- streaming


@query
def stream_timeline(spark, sf):
    """The streaming aggregate run over the table as a batch."""
    rows = stateful.stream_timeline(b.interactions(spark, sf), "1 hour")
    return rows.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm"))


@query
def stream_product_counters(spark, sf):
    return stateful.stream_product_counters(b.web_events(spark, sf)).drop("last_ts")


@query
def dedup_events(spark, sf):
    """Double tracking dropped in a batch; the wide gap makes the table show some."""
    rows = stateful.dedup_events(b.web_events(spark, sf), by_content=True, seconds=86_400)
    return rows.select("event_id", "user_id", "normalised_type", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query
def event_router(spark, sf):
    """Events as JSON through the router, one batch replayed: rows in each sink, and as counted while written."""
    root = shared_folder(spark, "router")
    rows = b.web_events(spark, sf)
    record = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"), "user_id", "event_type", "data",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "session_id",
    ))
    broken = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("broken "), F.col("event_id").cast("string")))
    rows.select(F.coalesce(broken, record).alias("value")).write.text(f"{root}/in")
    parsed = event_source.parse_events(event_source.file_source(spark, f"{root}/in"), rejects=True)
    jobs.event_router(parsed, f"{root}/out", f"{root}/state", available_now=True).awaitTermination()
    counts = spark.read.parquet(f"{root}/out/sink_counts")
    first = spark.read.text(f"{root}/in").select(F.col("value").cast("binary").alias("value"))
    jobs.route_batch(
        event_source.parse_events(first, rejects=True), 0, f"{root}/out", writer=counts.first()["writer"]
    )
    observed = spark.read.parquet(f"{root}/out/sink_counts").groupBy("sink").agg(F.sum("rows").alias("rows_counted"))
    stored = None
    for sink in ("raw_events", "rejected_events", "interactions"):
        rows = spark.read.parquet(f"{root}/out/{sink}").select(F.lit(sink).alias("sink"))
        stored = rows if stored is None else stored.unionByName(rows)
    stored = stored.groupBy("sink").agg(F.count("*").alias("rows_stored"))
    return observed.join(stored, "sink", "left").select("sink", "rows_stored", "rows_counted")


@query
def stream_refresh(spark, sf):
    """The lists after each of six daily micro-batches of the stateful refresh."""
    root = shared_folder(spark, "lists")
    rows = b.web_events(spark, sf)
    # written once: each micro-batch reads the tables of candidates again
    _trending(spark, sf).write.parquet(f"{root}/trending")
    _shelf(spark, sf).write.parquet(f"{root}/shelf")
    trending, shelf = spark.read.parquet(f"{root}/trending"), spark.read.parquet(f"{root}/shelf")
    for back in range(6, 0, -1):
        day = rows.where(
            f"ts >= timestamp_ntz'{AS_OF}' - interval {back} days and ts < timestamp_ntz'{AS_OF}' - interval {back - 1} days"
        )
        day.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        lists = refresh_state.stream_lists(stream, trending, shelf)
        jobs.store_lists(lists, f"{root}/out", f"{root}/state", available_now=True).awaitTermination()
    stored = spark.read.parquet(f"{root}/out")
    # micro-batches without events, in which only timers run, take numbers too
    days = stored.groupBy("batch_id").agg((F.row_number().over(Window.orderBy("batch_id")) - 1).cast("bigint").alias("day"))
    rows = stored.join(days, "batch_id")
    return rows.select("day", "user_id", F.posexplode("product_ids").alias("_p", "product_id")).select(
        "day", "user_id", (F.col("_p") + 1).cast("int").alias("rank"), "product_id"
    )


def _drained(rows: DataFrame, build: Callable[[DataFrame], DataFrame], name: str, last: dict) -> DataFrame:
    """What an append stream gives for the first half of the time, then the rest, then a ``last`` row that closes all before it."""
    spark = rows.sparkSession
    root = shared_folder(spark, name)
    half = f"ts < timestamp_ntz'{AS_OF}' - interval 15 days"
    far = F.to_timestamp_ntz(F.lit("2030-01-01 00:00:00"))
    end = spark.range(1).select(*(last.get(c, F.lit(None)).cast(t).alias(c) for c, t in rows.drop("ts").dtypes), far.alias("ts"))
    for part in (rows.where(half), rows.where(f"not ({half})"), end):
        part.write.mode("append").parquet(f"{root}/in")
        out = build(spark.readStream.schema(rows.schema).parquet(f"{root}/in"))
        writer = out.writeStream.outputMode("append").option("checkpointLocation", f"{root}/state")
        writer.format("parquet").trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out")


@query
def stream_timeline_levels(spark, sf):
    """Minutes added up to hours in one stream, over three micro-batches."""
    rows = b.interactions(spark, sf).select("interaction_type", "ts")
    out = _drained(rows, stateful.stream_timeline_levels, "timeline", {"interaction_type": F.lit("view")})
    return out.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm"))


@query
def live_users(spark, sf):
    """Distinct users of the last hour and five minutes at every minute of a day, from a stream's bitmaps."""
    rows = b.interactions(spark, sf).select("user_id", "ts")
    minutes = _drained(rows, stateful.stream_user_minutes, "users", {"user_id": F.lit(0).cast("bigint")})
    out = dashboards.live_users(minutes, AS_OF)
    return out.withColumn("minute_end", F.date_format("minute_end", "yyyy-MM-dd HH:mm"))


@query
def closed_sessions(spark, sf):
    """Tabs that end after two days without a heartbeat, closed by timers over three micro-batches."""
    rows = b.heartbeats(spark, sf).select("session_id", "ts")
    build = lambda s: session_state.closed_sessions(s, timedelta(days=2))
    out = _drained(rows, build, "sessions", {"session_id": F.lit("last")})
    times = [F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) for c in ("started_at", "last_activity")]
    return out.select("session_id", *times, "heartbeats")


@query
def keyed_latest(spark, sf):
    """Every event as a write of its user's row by the writer of its type; live rows."""
    writes = b.interactions(spark, sf).select(
        "user_id",
        "product_id",
        F.col("ts").alias("updated_at"),
        (F.col("ts") + F.expr(f"INTERVAL {keyed.TTL['trending_products']} SECONDS")).alias("expires_at"),
        F.col("interaction_id").alias("_version"),
        F.col("interaction_type").alias("_writer"),
        F.lit(True).alias("_late"),
    )
    rows = keyed.live(keyed.newest(writes, ["user_id"]), AS_OF)
    return rows.select("user_id", "product_id", "updated_at", F.col("_writer").alias("writer"))


@query
def counters_live(spark, sf):
    """Counts of the products written to without a pause of two days."""
    counter = counters.Counter(("product_id",), ("action",), 2 * keyed.DAY)
    rows = counters.increments(b.web_events(spark, sf), "product_counters")
    return counters.live_counters(rows, counter, AS_OF)


@query
def history_live(spark, sf):
    return counters.live_history(
        windows.bounded_history(b.web_events(spark, sf), "recent_views").drop("rank"), "recent_views", AS_OF
    )


@query
def session_activity(spark, sf):
    return stateful.session_activity(b.heartbeats(spark, sf))


@query
def gap_sessions(spark, sf):
    return stateful.gap_sessions(b.web_events(spark, sf), gap_minutes=60)


@query
def engagement_events(spark, sf):
    return stateful.engagement_events(b.page_events(spark, sf))


__all__ = ["QUERIES", "EVENT_SCHEMA"]
