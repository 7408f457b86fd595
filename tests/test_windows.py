import random

from clickloom.functions.ranking import top_n_per_group
from clickloom.operators import lists, windows
from pyspark.sql import functions as F

from shop import AS_OF, rows


def test_salted_top_n_equals_brute_force(spark):
    rng = random.Random(1)
    data = [(rng.choice([0, 0, 0, 1, 2]), rng.randrange(50), k) for k in range(2000)]
    df = spark.createDataFrame(data, "g int, v int, id int").repartition(8)
    out = top_n_per_group(df, ["g"], [F.desc("v"), F.asc("id")], 7, spread_by="id", spread=5)
    want = []
    for g in (0, 1, 2):
        best = sorted((r for r in data if r[0] == g), key=lambda r: (-r[1], r[2]))[:7]
        want += [(*r, k) for k, r in enumerate(best, 1)]
    assert sorted(rows(out)) == sorted(want)


def test_cap_comes_before_the_category_filter(shop):
    products = shop.products([(1, "A")])
    data = shop.interactions([(1, None, "search", 1), (1, 9, "view", 2), (1, 1, "view", 3), (1, 1, "view", 4)])
    recent = windows.recent_per_user(data, products, AS_OF, n=3)
    assert rows(recent.orderBy("pos"), "pos", "interaction_id", "category") == [(0, 0, None), (1, 1, None), (2, 2, "A")]


def test_equal_timestamps_rank_by_id(shop):
    data = shop.interactions([(3, p, "product_view", 5) for p in (1, 2, 3, 4)])
    products = shop.products([(k, "ABCD"[k - 1]) for k in range(1, 5)])
    assert [r[0] for r in rows(windows.recent_per_user(data, products, AS_OF, n=2).orderBy("pos"), "product_id")] == [4, 3]
    assert rows(windows.latest_category(data, products, AS_OF), "user_id", "category") == [(3, "D")]


def test_recency_weights_by_age_and_position(shop):
    ages = [30, 31, 300, 301, 3600, 3601, 86400, 86401]
    products = shop.products([(1, "A")])
    data = shop.interactions([(1, 1, "click", a) for a in ages])
    recent = windows.recent_per_user(data, products, AS_OF, days=2)
    got = [r[0] for r in rows(windows.recency_points(recent, AS_OF).orderBy("pos"), "tenths")]
    weight = [10, 8, 8, 5, 5, 2, 2, 1]
    assert got == [15 * w * (100 - k) for k, w in enumerate(weight)]


def test_position_weight_has_a_floor(shop):
    data = shop.interactions([(1, 1, "view", 60 + k) for k in range(95)])
    recent = windows.recent_per_user(data, shop.products([(1, "A")]), AS_OF, days=1)
    got = [r[0] for r in rows(windows.recency_points(recent, AS_OF).orderBy("pos"), "tenths")]
    assert got[89] == 12 * 8 * 11 and got[90] == got[94] == 12 * 8 * 10


def test_latest_category_skips_unknown(shop):
    products = shop.products([(1, "A"), (2, None)])
    data = shop.interactions([(1, 2, "view", 1), (1, 1, "click", 5), (2, 2, "view", 1), (3, 1, "view", 4000)])
    assert rows(windows.latest_category(data, products, AS_OF, 30), "user_id", "category") == [(1, "A")]


def test_event_lists_are_whole_and_ordered(shop):
    rng = random.Random(2)
    events = shop.events([(0 if k % 3 else 1, rng.choice("abc"), {"n": str(k)}, rng.randrange(9000)) for k in range(700)])
    out = windows.user_event_lists(events, chunk=50).orderBy("user_id", "part").collect()
    assert all(len(r.event_types) <= 50 for r in out)
    for u in (0, 1):
        want = [(r.event_type, r.data) for r in sorted(
            (r for r in events.collect() if r.user_id == u), key=lambda r: (r.ts, r.event_id))]
        got = [x for r in out if r.user_id == u for x in zip(r.event_types, r.event_data)]
        assert got == want


def test_bounded_history_keeps_newest(shop):
    events = shop.events([(1, "product_view", {"product_id": str(k)}, k) for k in range(60)])
    got = rows(windows.bounded_history(events, "recent_views").orderBy("rank"), "rank", "product_id")
    assert got == [(k + 1, k) for k in range(50)]
    searches = shop.events([(1, "search", {"query": "x"}, 1), (1, "search", {"query": "y", "results_count": "3"}, 2)])
    assert rows(windows.bounded_history(searches, "search_history").orderBy("rank"), "query", "results_count") == [("x", 0), ("y", 3)]


def test_merge_ranked(spark):
    df = spark.createDataFrame(
        [(1, [1, 2], [2, 3]), (2, None, [4]), (3, [5], None), (4, list(range(10)), list(range(5, 20)))],
        "id int, n array<bigint>, c array<bigint>",
    )
    got = dict(rows(df.select("id", lists.merge_ranked(F.col("n"), F.col("c")))))
    assert got == {1: [1, 2, 3], 2: [4], 3: [5], 4: list(range(15))}


def test_window_feed_needs_enough_rows(shop):
    products = shop.products([(1, "A")])
    data = shop.interactions([(1, 1, "view", k) for k in range(10)])
    assert windows.window_feed(data, products, AS_OF, min_rows=10).count() == 0
    more = shop.interactions([(1, 1, "view", k) for k in range(11)])
    assert windows.window_feed(more, products, AS_OF, min_rows=10).count() == 11
    assert windows.window_feed(data, products, AS_OF, n=4).count() == 4


def test_list_rank(spark):
    df = spark.createDataFrame([(1, [(7, 0.5), (8, 0.25)])], "u int, recommendations array<struct<p:int,s:double>>")
    assert rows(windows.list_rank(df)) == [(1, 1, 7, 0.5), (1, 2, 8, 0.25)]
