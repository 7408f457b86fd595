"""Branches of the recommenders, and list invariants on random shops."""

import random
from datetime import timedelta

import pytest
from clickloom.operators import windows
from clickloom.plans import explain, publish, recommenders
from clickloom.sources import keyed

from shop import AS_OF

RELATIONS = {"A": ["B", "C", "D"], "B": ["C", "A", "D"], "C": ["A", "B", "D"], "D": ["A", "B", "C"]}
CATALOGUE = [(100 * c + k, "ABCD"[c]) for c in range(4) for k in range(1, 13)]
HISTORY = "user_id bigint, product_id bigint, category string, ts timestamp_ntz, position bigint"


def lists_of(df):
    return {
        r.user_id: (r.strategy_used, [(e.product_id, e.priority) for e in r.recommendations])
        for r in df.collect()
    }


@pytest.fixture(scope="module")
def catalogue(shop):
    return shop.products(CATALOGUE)


@pytest.fixture(scope="module")
def relations(shop):
    return shop.relations(RELATIONS)


def test_cascade_stages(shop, catalogue, relations):
    data = shop.interactions(
        [
            # user 1: click in A now, more clicks in B: stages 1 and 2 fill six
            (1, 1, "click", 10), (1, 101, "click", 20), (1, 102, "click", 30),
            # user 2: only a view in C, so 3 of C, then what resembles the view
            (2, 201, "view", 10),
            # user 3: only a category page without a product: trending
            (3, None, "category_view", 10),
            # user 4: clicks in A only: 4 of A, then related B and C
            (4, 5, "product_click", 10),
        ]
    )
    out = lists_of(
        recommenders.recommend_cascade(shop.users([1, 2, 3, 4, 5]), data, catalogue, relations, AS_OF, seed="x")
    )
    assert out[1][0] == "latest_click_based"
    # A: used products 1 and 5 first (newer id wins), then the newest.
    assert out[1][1] == [
        (5, "latest_click"), (1, "latest_click"), (12, "latest_click"), (11, "latest_click"),
        (102, "frequent_category"), (101, "frequent_category"),
    ]
    assert out[2][0] == "latest_view_based"
    assert out[2][1] == [
        (201, "latest_view"), (212, "latest_view"), (211, "latest_view"), (210, "similar_product"),
    ] + out[2][1][4:] and [p for _, p in out[2][1][4:]] == ["trending", "trending"]
    assert out[4][1][4:] == [(102, "related_category"), (212, "related_category")] or out[4][1][4:] == [
        (102, "related_category"), (201, "related_category"),
    ]
    assert out[3][0] == out[5][0] == "trending_based"
    assert {p for _, p in out[5][1]} == {"trending"} and len(out[5][1]) == 6
    # five used products lead the global list
    assert {i for i, _ in out[5][1][:5]} == {1, 5, 101, 102, 201}


def test_cascade_views_of_category_pages_only(shop, catalogue, relations):
    data = shop.interactions([(1, 3, "category_view", 10)])
    out = lists_of(recommenders.recommend_cascade(shop.users([1]), data, catalogue, relations, AS_OF))
    assert out[1][0] == "frequent_views_based" and len(out[1][1]) == 6


def test_cascade_small_category_is_filled_by_later_stages(shop, relations):
    products = shop.products([(1, "A"), (2, "B"), (3, "C"), (4, "D")])
    data = shop.interactions([(1, 1, "click", 10)])
    out = lists_of(recommenders.recommend_cascade(shop.users([1]), data, products, relations, AS_OF))
    assert out[1][1][:3] == [(1, "latest_click"), (2, "related_category"), (3, "related_category")]
    assert sorted(i for i, _ in out[1][1]) == [1, 2, 3, 4]


def test_same_plus_related(shop, catalogue, relations):
    data = shop.interactions(
        [
            (1, 12, "click", 10), (1, 101, "view", 20),
            (2, 305, "search", 10),
            (3, None, "click", 5), (3, 204, "product_view", 10),
            (4, 999, "click", 5),
        ]
    )
    out = lists_of(
        recommenders.recommend_same_plus_related(
            shop.users([1, 2, 3, 4, 5]), data, catalogue, relations, AS_OF, default_category="B"
        )
    )
    assert out[1][0] == "same_category_plus_related"
    assert out[1][1] == [(k, "same_category") for k in range(11, 3, -1)] + [
        (112, "related_category"), (212, "related_category"),
    ]
    assert out[2] == ("view_based_fallback", [(k, "viewed_category") for k in range(312, 306, -1)])
    assert out[3][1][0] == (212, "same_category") and (204, "same_category") not in out[3][1]
    assert out[4] == out[5] == ("no_data_fallback", [(k, "fallback") for k in range(112, 106, -1)])


def test_same_plus_related_with_a_short_category(shop, relations):
    products = shop.products([(k, "A") for k in (1, 2, 3)] + [(9, "C")])
    out = lists_of(
        recommenders.recommend_same_plus_related(
            shop.users([1]), shop.interactions([(1, 2, "click", 1)]), products, relations, AS_OF
        )
    )
    assert out[1][1] == [(3, "same_category"), (1, "same_category"), (9, "related_category")]


def test_instant_switch_branches(shop, catalogue, relations):
    data = shop.interactions(
        [
            # 1: a fresh view of B beats many older clicks in A
            (1, 101, "view", 60), *[(1, 1, "click", 4000 + k) for k in range(5)],
            # 2: nothing fresh: best score of the week, click 3 against view 2
            (2, 201, "view", 4000), (2, 1, "click", 5000),
            # 3: only rows without a category; 4: only rows too old
            (3, None, "search", 50), (4, 1, "click", 86400 * 8),
        ]
    )
    recs = recommenders.recommend_instant_switch(shop.users([1, 2, 3, 4, 5]), data, catalogue, relations, AS_OF, seed="s")
    main = {r.user_id: r.main_category for r in recs.collect()}
    out = lists_of(recs)
    assert main == {1: "B", 2: "A", 3: None, 4: None, 5: None}
    assert [out[u][0] for u in (1, 2, 3, 4, 5)] == [
        "real_data_instant_switch", "real_data_instant_switch", "no_category", "no_data", "no_data",
    ]
    assert out[3][1] == out[5][1] == []
    kinds = [p for _, p in out[1][1]]
    assert kinds == ["main_category"] * 8 + ["related_category"] * 2
    cat = dict(CATALOGUE)
    assert [cat[i] for i, _ in out[1][1]] == ["B"] * 8 + ["C", "A"]
    again = recommenders.recommend_instant_switch(shop.users([1]), data, catalogue, relations, AS_OF, seed="s")
    assert lists_of(again)[1] == out[1]
    other = recommenders.recommend_instant_switch(shop.users([1]), data, catalogue, relations, AS_OF, seed="t")
    assert lists_of(other)[1] != out[1]


def test_recency_sources_of_the_two_others(spark, shop, catalogue, relations):
    past = lambda u, p, c, h, pos=0: (u, p, c, AS_OF - timedelta(hours=h), pos)
    history = spark.createDataFrame(
        [past(1, 5, "A", 3), past(1, 101, "B", 2), past(1, 101, "B", 2, 1), past(1, 777, "D", 1),
         *[past(2, 301, "D", 50)], *[past(2, 1 + k, "A", 5) for k in range(10)]],
        HISTORY,
    )
    data = shop.interactions(
        [(u, 3, "click", 30) for u in (1, 2, 3, 4)]
        + [(4, 201, "search", 40), (4, 301, "search", 3000), (5, 301, "search", 10), (6, None, "click", 5)]
    )
    users = shop.users(range(1, 8))
    args = (users, data, catalogue)
    out = lists_of(recommenders.recommend_recency(*args, relations, history, AS_OF, seed="s"))
    others = lambda u, o=None: (o or out)[u][1][8:]
    cat = dict(CATALOGUE)
    assert [p for _, p in out[1][1][:8]] == ["main_category"] * 8
    # history: same category and unknown products are passed over, then related
    assert others(1)[0] == (101, "from_history") and others(1)[1][1] == "from_related"
    assert cat[others(1)[1][0]] == "B" and others(1)[1][0] != 101
    # the foreign entry of user 2 is older than the last ten
    assert [p for _, p in others(2)] == ["from_related", "from_related"]
    assert [cat[i] for i, _ in others(3)] == ["B", "C"]
    assert out[5] == ("no_main_category", []) and out[6] == out[7] == ("no_data_available", [])

    bare = lists_of(recommenders.recommend_recency(*args, shop.relations({"X": ["Y"]}), history, AS_OF, seed="s"))
    # viewed categories by score (the newer search weighs more), else discovery
    assert [(cat[i], p) for i, p in others(4, bare)] == [("C", "from_viewed"), ("D", "from_viewed")]
    assert others(3, bare) == [(101, "from_discovery"), (102, "from_discovery")]
    assert others(1, bare) == [(101, "from_history"), (102, "from_discovery")]

    mix = {r.user_id: r for r in recommenders.recommendation_mix(
        recommenders.recommend_recency(*args, relations, history, AS_OF, seed="s")).collect()}
    assert mix[1].main_category == 8 and mix[1].from_history == 1 and mix[1].main_ok
    assert mix[7].main_category == 0 and not mix[7].main_ok


def test_recency_without_products_of_the_main_category(spark, shop, relations):
    empty = spark.createDataFrame([], HISTORY)
    data = shop.interactions([(1, 1, "click", 10)])
    products = shop.products([(1, "A"), (2, "A"), (50, "D")])
    out = lists_of(recommenders.recommend_recency(shop.users([1]), data, products, relations, empty, AS_OF))
    assert sorted(out[1][1][:2]) == [(1, "main_category"), (2, "main_category")]
    assert out[1][1][2:] == [(50, "from_discovery")]


def test_history_is_kept_to_fifty(spark, shop, catalogue, relations):
    history = spark.createDataFrame(
        [(1, 1 + k % 12, "A", AS_OF - timedelta(days=1, seconds=k), 0) for k in range(49)], HISTORY
    )
    data = shop.interactions([(1, 3, "click", 30)])
    recs = recommenders.recommend_recency(shop.users([1]), data, catalogue, relations, history, AS_OF)
    grown = recommenders.append_history(history, recs, catalogue, AS_OF)
    assert grown.count() == 50
    assert grown.filter(grown.ts == AS_OF).count() == 10


@pytest.mark.parametrize("seed", [1, 2])
def test_lists_keep_their_invariants(spark, shop, catalogue, relations, seed):
    rng = random.Random(seed)
    kinds = ["click", "view", "search", "category_view", "product_click", "recommendation_click", "purchase"]
    data = [
        (0 if rng.random() < 0.35 else rng.randrange(25), rng.choice([None, *[p for p, _ in CATALOGUE]]),
         rng.choice(kinds), rng.randrange(86400 * 9))
        for _ in range(500)
    ]
    users = shop.users(range(30))
    empty = spark.createDataFrame([], HISTORY)
    base = shop.interactions(data)
    cat = dict(CATALOGUE)

    def check(make, n):
        one, many = lists_of(make(base.coalesce(1))), lists_of(make(base.repartition(7)))
        assert one == many and set(one) == set(range(30))
        for strategy, lst in one.values():
            ids = [i for i, _ in lst]
            assert len(ids) == len(set(ids)) <= n
        return one

    six = check(lambda i: recommenders.recommend_cascade(users, i, catalogue, relations, AS_OF), 6)
    assert all(len(lst) == 6 for _, lst in six.values())
    check(lambda i: recommenders.recommend_same_plus_related(users, i, catalogue, relations, AS_OF, default_category="A"), 10)
    check(lambda i: recommenders.recommend_instant_switch(users, i, catalogue, relations, AS_OF), 10)
    ten = check(lambda i: recommenders.recommend_recency(users, i, catalogue, relations, empty, AS_OF), 10)
    for strategy, lst in ten.values():
        if strategy == "instant_switch_8_plus_2":
            assert len({cat[i] for i, p in lst if p == "main_category"}) == 1
            assert sum(p == "main_category" for _, p in lst) == 8 and len(lst) == 10


def test_explanations(shop, catalogue, relations):
    data = shop.interactions(
        [(1, 1, "click", 10), (1, 101, "view", 20), (1, 102, "view", 25), (1, 201, "search", 5), (1, 301, "search", 60)]
    )
    recs = recommenders.recommend_same_plus_related(shop.users([1, 2]), data, catalogue, relations, AS_OF, default_category="A")
    recent = windows.recent_per_user(data, catalogue, AS_OF)
    got = {r.user_id: r for r in explain.explain_recommendations(recs, recent).collect()}
    assert got[1].recent_clicks_count == 3 and got[1].recent_interactions_count == 5
    assert [tuple(e) for e in got[1].top_clicked_categories] == [("B", 6), ("A", 3)]
    assert [tuple(e) for e in got[1].top_viewed_categories] == [("C", 1), ("D", 1)]
    assert got[1].latest_click_product == "product 1" and got[1].latest_interaction_category == "C"
    assert got[1].total == len(got[1].recommendation_reasons) == 10 and got[1].total_interactions == 11
    assert got[1].recommendation_reasons[0] == "Cùng danh mục với 'product 1'"
    assert got[2].strategy_used == "no_data_fallback" and got[2].recent_clicks_count == 0
    profile = {r.user_id: r for r in explain.behaviour_profile(recent).collect()}
    assert profile[1].favorite_products == [101, 102] and profile[1].recent_views_count == 2
    assert [tuple(e) for e in profile[1].searched_categories] == [("C", 1), ("D", 1)]


def test_published_lists_details_and_offers(spark, shop, tmp_path):
    products = shop.products([(k, "AB"[k % 2]) for k in range(12)])
    entry = "array<struct<product_id:bigint,priority:string,reason:string>>"

    def run(at, *ids):
        data = [(1, "s", [(i, "main_category", "r") for i in ids])]
        lists = spark.createDataFrame(data, f"user_id bigint, strategy_used string, recommendations {entry}")
        publish.run_recommendations(lists, products, str(tmp_path), at, "recency")

    def get(name, at):
        return keyed.read_keyed(spark, f"{tmp_path}/{name}", ["user_id"], at)

    assert publish.past_recommendations(spark, str(tmp_path)).count() == 0
    for _ in range(2):  # a second run for the same time replaces the first
        run(AS_OF, 3, 5)
    later = AS_OF + timedelta(hours=2)
    run(later, 7, 3)
    assert get("recommendations", later).first().product_ids == [7, 3]
    assert get("recommendations", later + timedelta(days=3)).count() == 0
    assert get("recommendation_details", later).first().recommendations[0].reason == "r"
    assert get("recommendation_details", later + timedelta(hours=1)).count() == 0
    past = [(r.product_id, r.position) for r in publish.past_recommendations(spark, str(tmp_path)).collect()]
    assert sorted(past) == [(3, 0), (3, 1), (5, 1), (7, 0)]
    for k in (3, 4):
        run(AS_OF + timedelta(hours=k), 1, 2)
    assert publish.past_recommendations(spark, str(tmp_path)).count() == 8


def test_stored_lists_keep_the_main_category(spark, shop, tmp_path):
    products = shop.products(CATALOGUE)
    seen = shop.interactions([(1, 101, "click", 60), (2, 5, "view", 30), (3, 201, "click", 10), (3, 202, "view", 20)])
    lists = recommenders.recommend_same_plus_related(
        shop.users([1, 2, 3]), seen, products, shop.relations(RELATIONS), AS_OF
    )
    publish.run_recommendations(lists.select("user_id", "strategy_used", "recommendations"), products, str(tmp_path), AS_OF, "same")
    details = keyed.read_keyed(spark, f"{tmp_path}/recommendation_details", ["user_id"], AS_OF)
    mix = recommenders.recommendation_mix(details).collect()
    assert len(mix) == 3 and all(r.main_ok for r in mix if r.main_category)
