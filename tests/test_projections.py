from clickloom.functions import scalars, weights
from clickloom.functions.times import trailing_window
from clickloom.operators import projections
from pyspark.sql import functions as F

from shop import AS_OF, rows


def test_price_band_edges(spark):
    prices = ["999999", "1000000", "4999999", "5000000", "10000000", "20000000", "abc", None]
    df = spark.createDataFrame([(p,) for p in prices], "p string")
    got = [r[0] for r in rows(df.select(scalars.price_band(F.col("p"))))]
    assert got == ["under_1m", "1m_5m", "1m_5m", "5m_10m", "10m_20m", "over_20m", None, None]


def test_search_is_plain_text_and_ignores_case(shop):
    products = shop.products(
        [
            (1, "A", 1.0, "Gạo tẻ Long An", None),
            (2, "A", 1.0, "100% cotton", "soft"),
            (3, "B", 1.0, "1000 nails", "GẠO bag"),
        ]
    )
    ids = lambda *a: sorted(r[0] for r in rows(projections.product_search(products, *a), "product_id"))
    assert ids("gạo") == [1, 3]
    assert ids("100%") == [2]
    assert ids("gạo", "B") == [3]
    assert ids() == [1, 2, 3]
    assert ids("_") == []


def test_browse_category_pages(shop):
    products = shop.products([(k, "A" if k % 2 else "B") for k in range(1, 31)])
    page = rows(projections.browse_category(products, "A", 2, 4), "product_id", "total")
    assert page == [(9, 15), (11, 15), (13, 15), (15, 15)]
    assert rows(projections.browse_category(products, "none")) == []


def test_normalised_types(shop):
    types = ["product_card_click", "page_load", "search_submit", "scroll_depth", "product_view"]
    events = shop.events([(1, t, {}, 0) for t in types] + [(1, "click", {"event_type": "product_link_click"}, 0)])
    got = rows(projections.normalise_event_type(events), "raw_type", "normalised_type")
    assert got == [
        ("product_card_click", "click"),
        ("page_load", "view"),
        ("search_submit", "search"),
        ("scroll_depth", "other"),
        ("product_view", "view"),
        ("product_link_click", "click"),
    ]


def test_to_interaction_branches(shop):
    events = shop.events(
        [
            (1, "product_view", {"product_id": "5"}, 9),
            (1, "product_view", {}, 8),
            (1, "click", {"product_id": "5", "action": "add_to_cart"}, 7),
            (1, "click", {"product_id": "5"}, 6),
            (1, "click", {"action": "buy"}, 5),
            (1, "product_card_click", {"product_id": "6", "is_recommendation": "true"}, 4),
            (1, "product_card_click", {"product_id": "6", "is_recommendation": "false"}, 3),
            (1, "recommendation_click", {"product_id": "7"}, 2),
            (1, "recommendation_click", {}, 2),
            (1, "search", {"query": "x"}, 1),
            (1, "click", {"event_type": "recommendation_click", "product_id": "8"}, 0),
        ]
    )
    got = rows(projections.to_interaction(events), "product_id", "interaction_type")
    assert got == [
        (5, "view"),
        (None, "view"),
        (5, "click_add_to_cart"),
        (6, "card_click_recommendation"),
        (6, "card_click"),
        (7, "recommendation_click"),
        (8, "recommendation_click"),
    ]


def test_extract_product_id_and_payload(spark, shop):
    events = shop.events(
        [(1, "x", d, 0) for d in ({"product": "4"}, {"id": "3", "product_id": "2"}, {"id": "no"}, {})]
    )
    assert rows(projections.extract_product_id(events), "product_id") == [(4,), (2,), (None,), (None,)]
    texts = spark.createDataFrame([('{"a": 1}',), ("plain",), (None,), ("[1]",)], "t string")
    got = [r[0] for r in rows(texts.select(scalars.payload_map(F.col("t"))))]
    assert got == [{"a": "1"}, {"info": "plain"}, {}, {"info": "[1]"}]


def test_details_survive_broken_json(shop):
    df = shop.interactions(
        [
            (3, 1, "product_view", 0, "Gạo tẻ Long An"),
            (3, None, "search", 0, '{"query":"gạo","results_count":5}'),
            (3, 1, "click", 0, '{"action":"add_to_cart"}'),
        ]
    )
    got = rows(projections.parse_details(df), "detail_action", "detail_query")
    assert got == [(None, None), (None, "gạo"), ("add_to_cart", None)]
    scored = rows(projections.with_cascade_family(df), "family", "score")
    assert scored == [("viewed", 2), ("searched", 1), ("clicked", 8)]


def test_simple_family_drops_other_types(shop):
    df = shop.interactions([(1, 1, t, 0) for t in ("click", "product_view", "search", "purchase")])
    got = rows(projections.with_simple_family(df), "interaction_type", "family", "score")
    assert got == [("click", "clicked", 3), ("product_view", "clicked", 3), ("search", "viewed", 1)]


def test_trailing_window_bounds(shop):
    df = shop.interactions([(1, 1, "view", s) for s in (0, 5, 6, -1)])
    assert [r[0] for r in rows(trailing_window(df, AS_OF, seconds=5), "interaction_id")] == [0, 1]
    more = df.union(shop.interactions([(1, 1, "product_view", 1)]))
    assert trailing_window(more, AS_OF, seconds=5).count() == 3


def test_presets_fall_back_to_their_default(shop):
    df = shop.interactions([(1, 1, t, 0) for t in ("view", "click", "click_add_to_cart", "unknown")])
    score = lambda p: [r[0] for r in rows(projections.with_score(df, p), "score")]
    assert score(weights.PREFERENCE) == [1, 2, 5, 1]
    assert score(weights.TRENDING) == [1, 3, 10, 1]
    assert score(weights.ENGAGEMENT) == [1, 3, 1, 1]
