import random

from clickloom.functions.times import trailing_window
from clickloom.operators import aggregates, dashboards, joins, lists
from clickloom.streaming import stateful
from pyspark.sql import functions as F

from shop import AS_OF, rows


def test_rule_segments_reach_every_branch(shop):
    plan = {1: (5, 45), 2: (0, 50), 3: (1, 19), 4: (0, 20), 5: (0, 5), 6: (0, 4), 7: (6, 0)}
    data = [
        (u, k % 3, t, 10)
        for u, (clicks, views) in plan.items()
        for t, n in (("click", clicks), ("view", views))
        for k in range(n)
    ]
    out = aggregates.user_segments_rule(
        shop.interactions(data), shop.products([(k, "A", 2.0 + k) for k in range(3)])
    )
    got = {r.user_id: r for r in out.collect()}
    assert {u: r.segment for u, r in got.items()} == {
        1: "high_engagement", 2: "low_engagement", 3: "medium_engagement", 4: "low_engagement",
        5: "low_engagement", 6: "new_user", 7: "low_engagement",
    }
    assert got[7].ctr == 0.0 and got[1].ctr == 5 / 45


def test_implicit_rating_bounds(shop):
    data = [(1, 1, "view", 0)] + [(1, 2, "view", k) for k in range(2)] + [(1, 3, "purchase", k) for k in range(30)]
    got = {r.product_id: r.rating for r in aggregates.implicit_ratings(shop.interactions(data)).collect()}
    assert 1 not in got and round(got[2], 6) == round(1.0986122886681098 + 0.2, 6) and got[3] == 5.0


def test_windowed_left_joins_differ_in_old_products(shop):
    products = shop.products([(1, "A"), (2, "A"), (3, "A")])
    data = shop.interactions([(1, 2, "view", 30 * 86400), (1, 3, "view", 60), (1, 3, "view", 40 * 86400)])
    on = rows(joins.products_left_recent(products, data, AS_OF, 7).orderBy("product_id"), "product_id", "interaction_count")
    where = rows(joins.products_left_recent_where(products, data, AS_OF, 7).orderBy("product_id"), "product_id", "interaction_count")
    assert on == [(1, 0), (2, 0), (3, 1)]
    assert where == [(1, 0), (3, 1)]


def test_timeline_falls_back_to_hours(shop):
    old = shop.interactions([(1, 1, "click", 86400), (1, 1, "product_view", 86400 + 60)])
    bucket = rows(dashboards.activity_timeline(old, AS_OF), "clicks", "views", "purchases")
    assert bucket == [(1, 0, 0), (0, 1, 0)]
    fresh = shop.interactions([(1, 1, "click", 30), (1, 1, "click", 40), (1, 1, "purchase", 7000)])
    line = dashboards.activity_timeline(fresh, AS_OF)
    assert rows(line, "clicks", "views", "purchases") == [(2, 0, 0), (0, 0, 1)]
    assert rows(dashboards.latest_bucket(line), "clicks", "purchases") == [(2, 0)]


def test_left_joins_keep_rows_without_partner(shop):
    data = shop.interactions([(1, None, "search", 1), (1, 9, "view", 2), (2, 1, "view", 3), (None, None, "view", 4)])
    joined = joins.interactions_left_product(data, shop.products([(1, "A")]))
    assert rows(joined.orderBy("interaction_id"), "interaction_id", "category") == [
        (0, None), (1, None), (2, "A"), (3, None),
    ]
    users = joins.users_left_interactions(shop.users([1, 5]), data)
    assert sorted(rows(users, "user_id", "interaction_id"), key=str) == sorted([(1, 0), (1, 1), (5, None)], key=str)


def test_exclude_ids_is_null_safe(spark):
    c = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "user_id bigint, product_id bigint")
    seen = spark.createDataFrame([(1, 1), (1, None)], "user_id bigint, product_id bigint")
    assert sorted(rows(joins.exclude_ids(c, seen, ["user_id", "product_id"]))) == [(1, 2), (2, 1)]


def test_category_performance_counts_idle_products_once(shop):
    products = shop.products([(1, "A", 10.0), (2, "A", 20.0), (3, "B", 5.0)])
    data = shop.interactions([(1, 1, "view", 1), (1, 1, "view", 2), (2, 1, "click", 3)])
    got = rows(dashboards.category_performance(products, data, shop.users([1, 2, 3, 4])))
    assert got == [("A", 3, 50.0, 12.5, 0.5), ("B", 0, 5.0, 5.0, 0.0)]


def test_profile_counters_and_interests(shop):
    events = shop.events(
        [
            (1, "product_view", {"category": "A", "price": "5", "product_id": "3"}, 9),
            (1, "click", {"category": "A", "price": "oops"}, 8),
            (1, "recommendation_click", {"category": "B", "price": "5000000", "product_id": "2"}, 7),
            (1, "product_view", {"product_id": "3"}, 6),
            (1, "search", {"category": "C"}, 5),
        ]
    )
    counters = sorted(rows(aggregates.user_profile_counters(events)))
    assert counters == [(1, "category", "A", 2), (1, "category", "B", 1), (1, "price_range", "under_1m", 1)]
    seen = aggregates.user_interests(events).filter("kind = 'recent_product'").orderBy("first_ts")
    assert rows(seen, "value", "count") == [("3", 2), ("2", 1)]


def test_sessions(shop):
    beats = shop.events(
        [
            (1, "beat", {}, 600, "tab_1_1_abc123"),
            (1, "beat", {}, 10, "tab_1_1_abc123"),
            (1, "beat", {}, 20, "tab_1_2_abc123"),
            (2, "beat", {}, 30, "tab_2_1_abc123"),
            (2, "beat", {}, 300, "tab_2_2_abc123"),
            (2, "beat", {}, 301, "tab_2_3_abc123"),
            (None, "beat", {}, 40, "test_session_1"),
        ]
    )
    sessions = stateful.session_activity(beats)
    active = [r[0] for r in rows(dashboards.active_sessions(sessions, AS_OF), "session_id")]
    assert active == ["tab_1_1_abc123", "tab_1_2_abc123", "tab_2_1_abc123", "test_session_1", "tab_2_2_abc123"]
    assert rows(dashboards.active_session_count(sessions, AS_OF)) == [(5,)]
    assert sorted(rows(dashboards.active_sessions_by_user(sessions, AS_OF))) == [(0, 1), (1, 2), (2, 2)]
    left = lists.drop_matching_sessions(sessions, "tab_", AS_OF)
    assert rows(left, "session_id") == [("test_session_1",)]


def test_gap_sessions_equal_session_window(spark, shop):
    rng = random.Random(5)
    events = shop.events([(rng.randrange(4), "x", {}, rng.randrange(20000)) for _ in range(400)])
    ours = stateful.gap_sessions(events, 5).select(
        "user_id", "session_start", "session_end", "event_count"
    )
    window = (
        events.groupBy(F.session_window("ts", "5 minutes"), "user_id")
        .agg(F.count(F.lit(1)).alias("event_count"), F.max("ts").alias("session_end"))
        .select("user_id", F.col("session_window.start").alias("session_start"), "session_end", "event_count")
    )
    assert sorted(rows(ours)) == sorted(rows(window))


def test_results_do_not_depend_on_partitioning(shop):
    rng = random.Random(3)
    data = [
        (0 if rng.random() < 0.4 else rng.randrange(6), rng.choice([None, *range(8)]),
         rng.choice(["view", "click", "purchase"]), rng.randrange(86400 * 6))
        for _ in range(600)
    ]
    products = shop.products([(k, "AB"[k % 2], 10.1 + k) for k in range(8)])
    base = shop.interactions(data)
    for run in (
        lambda i: aggregates.user_features(i, products, AS_OF),
        lambda i: aggregates.user_activity_summary(i, products, AS_OF),
        lambda i: aggregates.user_segments_rule(i, products),
        lambda i: dashboards.category_performance(products, i, shop.users(range(6))),
    ):
        assert sorted(map(str, rows(run(base.coalesce(1))))) == sorted(map(str, rows(run(base.repartition(8)))))


def test_live_metrics_rates(shop):
    data = shop.interactions([(k % 7, 1, "view", k % 3600) for k in range(4000)])
    r = dashboards.live_metrics(data, AS_OF).first()
    assert (r.total_users, r.total_interactions, r.per_second, r.per_minute) == (7, 4000, 1, 66)
    empty = dashboards.live_metrics(trailing_window(data, "2020-01-01 00:00:00", days=1), AS_OF).first()
    assert empty.total_interactions == 0 and empty.per_second == 0
