"""The same results in plain SQL, written set by set for an independent check.

Each text starts from the bound views below and is run by another engine over
the whole tables.
"""

from __future__ import annotations

from clickloom.registry.binding import PREDICTED_TYPES

ORACLE: dict[str, str] = {}

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
SEED = "7"
LABELS = ("under_1m", "1m_5m", "5m_10m", "10m_20m", "over_20m")
EDGES = (902, 905, 907, 909)

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

# The bound views, by the name the queries use for them.
VIEWS = {
    "i": f"""SELECT event_id AS interaction_id, user_id, {K} AS product_id,
        event_type AS interaction_type, ts FROM events""",
    "s": f"""SELECT event_id AS interaction_id, user_id,
        CASE WHEN event_type = 'signup' AND value < 10 THEN NULL ELSE {K} END AS product_id,
        CASE event_type WHEN 'purchase' THEN 'recommendation_click' WHEN 'signup' THEN 'search'
             WHEN 'error' THEN 'category_view' ELSE event_type END AS interaction_type,
        event_type = 'click' AND value >= 20 AS to_cart,
        CASE WHEN event_type = 'signup' THEN 'k' || {K} END AS query, ts FROM events""",
    "p": """SELECT p_partkey AS product_id, p_name AS name, p_brand AS description,
        p_type AS category, p_retailprice AS price, CAST(p_retailprice AS DECIMAL(18,4)) AS money
        FROM part""",
    "u": "SELECT c_custkey AS user_id, c_name AS username FROM customer",
    "r": """SELECT * FROM (VALUES
        ('ECONOMY','LARGE',1),('ECONOMY','MEDIUM',2),('ECONOMY','PROMO',3),
        ('LARGE','MEDIUM',1),('LARGE','PROMO',2),('LARGE','SMALL',3),
        ('MEDIUM','PROMO',1),('MEDIUM','SMALL',2),('MEDIUM','STANDARD',3),
        ('PROMO','SMALL',1),('PROMO','STANDARD',2),('PROMO','ECONOMY',3),
        ('SMALL','STANDARD',1),('SMALL','ECONOMY',2),('SMALL','LARGE',3),
        ('STANDARD','ECONOMY',1),('STANDARD','LARGE',2),('STANDARD','MEDIUM',3)
        ) t(category, related_category, rel_rank)""",
    "e": f"""SELECT event_id, user_id, {K} AS k,
        CASE event_type WHEN 'view' THEN 'product_view' WHEN 'purchase' THEN 'recommendation_click'
             WHEN 'signup' THEN 'search' WHEN 'error' THEN 'page_view' ELSE event_type END AS event_type,
        CASE WHEN event_type NOT IN ('signup', 'error') THEN {K} END AS product_id,
        CASE WHEN event_type NOT IN ('signup', 'error') THEN p_type END AS category,
        CASE WHEN event_type NOT IN ('signup', 'error') THEN p_retailprice END AS price,
        CASE WHEN value >= 20 THEN 'add_to_cart' ELSE 'view_product' END AS action, ts
        FROM events LEFT JOIN part ON p_partkey = {K}""",
    "b": """SELECT 'tab_' || user_id || '_' || event_type AS session_id,
        arg_max(CASE WHEN event_type <> 'error' THEN user_id END, ts) AS user_id,
        max(ts) AS last_activity, min(ts) AS created_at FROM events
        GROUP BY 'tab_' || user_id || '_' || event_type""",
    "buy": """SELECT o_custkey AS user_id, l_partkey AS product_id, 'purchase' AS interaction_type
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}


def sql(views: str, body: str, *more: str) -> str:
    """``WITH`` the named views and further CTEs, then the body."""
    ctes = [f"{v} AS ({VIEWS[v]})" for v in views.split()] + list(more)
    return f"WITH {', '.join(ctes)} {body}" if ctes else body


def add(name: str, views: str, body: str, *more: str) -> None:
    ORACLE[name] = sql(views, body, *more)


def since(**interval: int) -> str:
    ((unit, count),) = interval.items()
    return f"ts >= {NOW} - INTERVAL {count} {unit} AND ts <= {NOW}"


def case(points: dict[str, int], default: int = 1) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in points.items())
    return f"CAST(CASE interaction_type {whens} ELSE {default} END AS BIGINT)"


PREFERENCE = case({"view": 1, "click": 2, "click_add_to_cart": 5, "recommendation_click": 3})
TRENDING = case({"view": 1, "click": 3, "click_add_to_cart": 10})
ENGAGEMENT = case({"view": 1, "click": 3, "purchase": 5})
INSTANT = case({"click": 3, "product_click": 3, "view": 2, "product_view": 2})
CLICK = "interaction_type IN ('click', 'product_click')"
VIEW = "interaction_type IN ('view', 'product_view')"
FAMILY = f"""CASE WHEN {CLICK} THEN 'clicked' WHEN {VIEW} THEN 'viewed'
    WHEN interaction_type = 'search' THEN 'searched'
    WHEN interaction_type = 'category_view' THEN 'viewed' END"""
POINTS = f"""CAST(CASE WHEN {CLICK} THEN 3 + CASE WHEN to_cart THEN 5 ELSE 0 END
    WHEN {VIEW} THEN 2 WHEN interaction_type IN ('search', 'category_view') THEN 1
    ELSE 0 END AS BIGINT)"""


def band(price: str) -> str:
    whens = " ".join(f"WHEN {price} < {e} THEN '{x}'" for e, x in zip(EDGES, LABELS))
    return f"CASE WHEN {price} IS NULL THEN NULL {whens} ELSE '{LABELS[-1]}' END"


def capped(days: int, n: int, source: str = "s") -> str:
    """Newest ``n`` interactions per user with product columns, as ``rc``."""
    return f"""rc AS (SELECT t.*, name, category, price FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, interaction_id DESC) - 1
            AS INTEGER) AS pos FROM {source} WHERE {since(days=days)}) t
        LEFT JOIN p USING (product_id) WHERE pos < {n})"""


# ------------------------------------------------- sources and projections

add("load_interactions", "i p", f"""SELECT interaction_id, user_id, product_id, category, price,
    name AS product_name FROM i JOIN p USING (product_id) WHERE {since(days=30)}""")
add("load_raw_events", "", f"""SELECT event_id, user_id, event_type, props, ts FROM events
    WHERE {since(days=7)}""")
add("read_parquet_table", "", "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_type = 'PROMO'")
add("parse_events", "e", """SELECT event_id, user_id, event_type, product_id,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_second FROM e""")
add("score_preference", "s", f"SELECT interaction_id, {PREFERENCE} AS score FROM s")
add("score_trending", "s", f"SELECT interaction_id, {TRENDING} AS score FROM s")
add("score_engagement", "i", f"SELECT interaction_id, {ENGAGEMENT} AS score FROM i")
add("score_cascade", "s", f"SELECT interaction_id, {FAMILY} AS family, {POINTS} AS score FROM s")
add("score_simple", "s", f"""SELECT interaction_id,
    CASE WHEN interaction_type = 'search' THEN 'viewed' ELSE 'clicked' END AS family,
    CAST(CASE WHEN interaction_type = 'search' THEN 1 ELSE 3 END AS BIGINT) AS score
    FROM s WHERE {CLICK} OR {VIEW} OR interaction_type = 'search'""")
add("score_instant", "s", f"SELECT interaction_id, {INSTANT} AS score FROM s")

AGE = f"datediff('microsecond', ts, {NOW}) // 1000000"
RECENCY = f"""w AS (SELECT interaction_id, user_id, category,
    CASE WHEN interaction_type = 'search' THEN 'viewed' ELSE 'clicked' END AS family,
    CAST(CASE WHEN interaction_type = 'search' THEN 4 WHEN {VIEW} THEN 12 ELSE 15 END
      * CASE WHEN {AGE} <= 30 THEN 10 WHEN {AGE} <= 300 THEN 8 WHEN {AGE} <= 3600 THEN 5
             WHEN {AGE} <= 86400 THEN 2 ELSE 1 END
      * greatest(100 - pos, 10) AS BIGINT) AS tenths FROM rc
    WHERE category IS NOT NULL
      AND ({CLICK} OR {VIEW} OR interaction_type IN ('recommendation_click', 'search')))"""
add("score_recency", "s p", "SELECT interaction_id, family, tenths / 10 AS score FROM w",
    capped(1, 100), RECENCY)
add("time_columns", "i", """SELECT interaction_id, CAST(hour(ts) AS INTEGER) AS hour_of_day,
    CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week FROM i""")
add("price_band", "p", f"SELECT product_id, {band('price')} AS price_band FROM p")
add("trailing_24h", "i", f"SELECT interaction_id, user_id, ts FROM i WHERE {since(hours=24)}")
IMPORTANT = "event_type IN ('product_view', 'click', 'recommendation_click', 'search')"
add("important_events", "e", f"SELECT event_id, user_id, event_type FROM e WHERE {IMPORTANT}")
add("click_like", "s", "SELECT interaction_id, interaction_type FROM s WHERE interaction_type LIKE '%click%'")
add("complete_pairs", "s", "SELECT interaction_id, user_id, product_id FROM s WHERE product_id IS NOT NULL")
add("product_search", "p", """SELECT product_id, name, category FROM p
    WHERE (name ILIKE '%ring%' OR description ILIKE '%ring%') AND category = 'PROMO'""")
add("document_search", "", """SELECT doc_id AS product_id, lang AS category FROM documents
    WHERE contains(lower(text), 'the') AND lang = 'en'""")
add("browse_category", "p", """SELECT product_id, name,
    (SELECT count(*) FROM p WHERE category = 'PROMO') AS total FROM p WHERE category = 'PROMO'
    ORDER BY product_id LIMIT 12 OFFSET 12""")
add("normalise_event_type", "e", """SELECT event_id, event_type AS raw_type,
    CASE WHEN event_type = 'recommendation_click' THEN 'click' WHEN event_type = 'product_view' THEN 'view'
    ELSE 'other' END AS normalised_type FROM e""")
add("to_interaction", "e", """SELECT event_id, user_id, product_id,
    CASE event_type WHEN 'product_view' THEN 'view' WHEN 'click' THEN 'click_' || action
    ELSE event_type END AS interaction_type, ts FROM e
    WHERE event_type IN ('product_view', 'click', 'recommendation_click')""")
add("extract_product_id", "e", "SELECT event_id, product_id FROM e")
add("parse_details", "s", """SELECT interaction_id, CASE WHEN to_cart THEN 'add_to_cart' END AS detail_action,
    query AS detail_query FROM s""")
# Ranks count the list positions, so entries without a product leave a gap.
add("hydrate_ranked", "s p", """SELECT user_id, CAST(pos + 1 AS INTEGER) AS rank, product_id,
    name, category FROM rc WHERE name IS NOT NULL""", capped(7, 10))
add("lookup_product", "p", "SELECT product_id, name, category, price FROM p WHERE product_id = 42")

# -------------------------------------------------------------------- joins

add("interactions_inner_product", "s p",
    "SELECT interaction_id, product_id, name, category FROM s JOIN p USING (product_id)")
add("interactions_left_product", "s p",
    "SELECT interaction_id, s.product_id, name, category FROM s LEFT JOIN p USING (product_id)")
add("products_left_recent", "i p", f"""SELECT p.product_id, name, count(i.interaction_id) AS interaction_count
    FROM p LEFT JOIN i ON i.product_id = p.product_id AND {since(days=7)} GROUP BY ALL""")
add("products_left_recent_where", "i p", f"""SELECT p.product_id, name,
    count(i.interaction_id) AS interaction_count FROM p LEFT JOIN i ON i.product_id = p.product_id
    WHERE ts IS NULL OR ({since(days=1)}) GROUP BY ALL""")
add("users_left_interactions", "i u", """SELECT u.user_id, username, interaction_id, interaction_type
    FROM u LEFT JOIN i USING (user_id)""")
add("interactions_user_product", "s u p", """SELECT interaction_id,
    coalesce(username, 'User ' || s.user_id) AS username,
    coalesce(p.name, 'Product ' || s.product_id) AS product_name
    FROM s LEFT JOIN u USING (user_id) LEFT JOIN p USING (product_id)""")
add("exclude_ids", "i", """SELECT DISTINCT user_id, product_id FROM i EXCEPT
    SELECT user_id, product_id FROM i WHERE interaction_type = 'purchase'""")
add("in_ids", "i p", """SELECT product_id, name FROM p WHERE product_id IN
    (SELECT product_id FROM i WHERE interaction_type = 'purchase')""")
add("related_categories", "i p r", f"""SELECT user_id, t.category, related_category,
    CAST(rel_rank AS INTEGER) AS rel_rank FROM (
      SELECT user_id, category, row_number() OVER (PARTITION BY user_id ORDER BY sum({PREFERENCE}) DESC, category) AS k
      FROM i JOIN p USING (product_id) GROUP BY user_id, category) t
    JOIN r USING (category) WHERE k = 1 AND rel_rank <= 2""")
FAVOURITES = f"""fav AS (SELECT * FROM (SELECT user_id, product_id, count(*) AS interaction_count,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, product_id) AS INTEGER) AS rank
    FROM i WHERE {VIEW} GROUP BY user_id, product_id))"""
add("similar_products", "i p", """SELECT user_id, CAST(rank AS INTEGER) AS rank, product_id, category FROM (
    SELECT user_id, product_id, category, row_number() OVER (PARTITION BY user_id ORDER BY product_id DESC) AS rank
    FROM (SELECT DISTINCT user_id, category FROM fav JOIN p USING (product_id) WHERE rank <= 5) c
    JOIN p USING (category)
    WHERE NOT EXISTS (SELECT 1 FROM fav f WHERE f.rank <= 5 AND f.user_id = c.user_id
                      AND f.product_id = p.product_id)) WHERE rank <= 3""", FAVOURITES)
add("scalar_total", "i u", """SELECT interaction_type, count(*) AS interaction_count,
    (SELECT count(*) FROM u) AS all_users FROM i GROUP BY interaction_type""")

# --------------------------------------------------------------- aggregates

add("user_product_scores", "s p", f"""SELECT user_id, product_id,
    CAST(sum({PREFERENCE}) AS BIGINT) AS total_score, min(category) AS category, min(price) AS price
    FROM s JOIN p USING (product_id) GROUP BY user_id, product_id""")
PREFS = f"""SELECT user_id, category, CAST(sum({PREFERENCE}) AS BIGINT) AS category_score,
    count(*) AS interaction_count FROM {{}} JOIN p USING (product_id) GROUP BY user_id, category"""
add("category_preferences", "s p", PREFS.format("s"))
add("purchase_preferences", "buy p", PREFS.format("buy"))


def trending(source: str, n: int) -> str:
    return f"""SELECT product_id, count(DISTINCT user_id) AS unique_users, count(*) AS total_interactions,
    CAST(sum({TRENDING}) AS BIGINT) AS trending_score, name AS product_name, category
    FROM {source} JOIN p USING (product_id) WHERE {since(days=7)} GROUP BY product_id, name, category
    ORDER BY trending_score DESC, product_id LIMIT {n}"""


add("trending_products", "s p", trending("s", 20))
add("user_segments_rule", "i p", """SELECT *, CASE WHEN total_interactions >= 50 AND ctr >= 0.1 THEN 'high_engagement'
      WHEN total_interactions >= 20 AND ctr >= 0.05 THEN 'medium_engagement'
      WHEN total_interactions >= 5 THEN 'low_engagement' ELSE 'new_user' END AS segment
    FROM (SELECT *, CASE WHEN view_count > 0 THEN click_count / view_count ELSE 0.0 END::DOUBLE AS ctr FROM m)""",
    f"""m AS (SELECT user_id, count(*) AS total_interactions, count(DISTINCT product_id) AS unique_products,
      CAST(sum(money) AS DOUBLE) / count(*) AS avg_price_interest,
      count(DISTINCT category) AS categories_explored,
      count(*) FILTER (WHERE interaction_type LIKE '%click%') AS click_count,
      count(*) FILTER (WHERE interaction_type = 'view') AS view_count
      FROM i JOIN p USING (product_id) WHERE {since(days=7)} GROUP BY user_id)""")


def features(source: str) -> str:
    return f"""x AS (SELECT {source}.*, category, money FROM {source} LEFT JOIN p USING (product_id)),
  wd AS (SELECT user_id, d FROM (SELECT user_id, dayofweek(ts) + 1 AS d,
      row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, dayofweek(ts) + 1) AS k
      FROM x GROUP BY user_id, dayofweek(ts) + 1) WHERE k = 1),
  mc AS (SELECT user_id, category FROM (SELECT user_id, category,
      row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, category) AS k
      FROM x WHERE category IS NOT NULL GROUP BY user_id, category) WHERE k = 1),
  ft AS (SELECT user_id, count(*) AS total_interactions, count(DISTINCT product_id) AS unique_products_viewed,
      count(DISTINCT x.category) AS categories_explored,
      CAST(sum({ENGAGEMENT}) AS BIGINT) AS total_engagement_score,
      CAST(sum({ENGAGEMENT}) AS DOUBLE) / count(*) AS avg_interaction_intensity,
      count(DISTINCT CAST(ts AS DATE)) AS active_days,
      CAST(sum(hour(ts)) AS DOUBLE) / count(*) AS avg_hour_activity,
      CAST(min(d) AS INTEGER) AS favorite_day_of_week,
      CAST(sum(CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-24' THEN {ENGAGEMENT} ELSE 0 END) AS BIGINT)
        AS recent_engagement,
      count(*) FILTER (WHERE interaction_type = 'click') AS total_clicks,
      count(*) FILTER (WHERE interaction_type = 'view') AS total_views,
      CAST(sum(money) AS DOUBLE) / count(money) AS avg_product_price_viewed,
      min(mc.category) AS most_viewed_category
      FROM x LEFT JOIN wd USING (user_id) LEFT JOIN mc USING (user_id)
      GROUP BY user_id HAVING count(*) >= 5)"""


add("user_features", "s p", "SELECT * FROM ft", features("s"))
RATED = f"""rt AS (SELECT * FROM (SELECT user_id, product_id, CAST(sum({ENGAGEMENT}) AS BIGINT) AS total_score,
    count(*) AS interaction_count, max(ts) AS last_interaction,
    least(5.0::DOUBLE, ln(sum({ENGAGEMENT}) + 1) + count(*) / 10) AS rating
    FROM {{}} WHERE product_id IS NOT NULL GROUP BY user_id, product_id) WHERE rating >= 1)"""
add("implicit_ratings", "i", """SELECT user_id, product_id, total_score, interaction_count, last_interaction,
    round(rating, 6) AS rating FROM rt""", RATED.format("i"))
add("top_products_stats", "i p", f"""SELECT p.product_id, name, category, price,
    count(i.interaction_id) AS interaction_count, count(DISTINCT i.user_id) AS unique_users,
    count(*) FILTER (WHERE interaction_type = 'click') AS clicks,
    count(*) FILTER (WHERE interaction_type = 'view') AS views
    FROM p LEFT JOIN i ON i.product_id = p.product_id WHERE ts IS NULL OR ({since(days=7)})
    GROUP BY p.product_id, name, category, price ORDER BY interaction_count DESC, p.product_id LIMIT 20""")
add("user_activity_summary", "s p", f"""SELECT user_id, count(*) AS total_interactions,
    count(DISTINCT s.product_id) AS unique_products, count(DISTINCT category) AS categories_explored,
    max(ts) AS last_activity, CAST(sum(money) AS DOUBLE) / count(money) AS avg_product_price
    FROM s LEFT JOIN p USING (product_id) WHERE {since(days=7)} GROUP BY user_id""")
add("category_product_counts", "i p", """SELECT category, p.product_id, count(i.interaction_id) AS interaction_count,
    min(price) AS avg_price FROM p LEFT JOIN i USING (product_id) GROUP BY category, p.product_id""")
add("category_counts", "i p", """SELECT category, count(i.interaction_id) AS interaction_count,
    CAST(sum(money) AS DOUBLE) / count(*) AS avg_price FROM p LEFT JOIN i USING (product_id) GROUP BY category""")


def timeline(unit: str, where: str) -> str:
    return f"""tl AS (SELECT date_trunc('{unit}', ts) AS bucket,
    count(*) FILTER (WHERE {CLICK}) AS clicks, count(*) FILTER (WHERE {VIEW}) AS views,
    count(*) FILTER (WHERE interaction_type = 'purchase') AS purchases
    FROM i WHERE {where} GROUP BY 1 ORDER BY 1 DESC LIMIT 24)"""


add("activity_timeline", "i", "SELECT * FROM tl", timeline("minute", since(hours=2)))
add("activity_timeline_hourly", "i", "SELECT * FROM tl", timeline("hour", "true"))
add("latest_bucket", "i", "SELECT * FROM tl ORDER BY bucket DESC LIMIT 1", timeline("minute", since(hours=2)))
add("category_performance", "s p u", """SELECT category, count(s.interaction_id) AS interaction_count,
    CAST(sum(money) AS DOUBLE) AS interaction_value, CAST(sum(money) AS DOUBLE) / count(*) AS avg_price,
    CAST(count(DISTINCT s.user_id) AS DOUBLE) / (SELECT count(*) FROM u) AS user_engagement
    FROM p LEFT JOIN s USING (product_id) WHERE category IS NOT NULL GROUP BY category""")
add("volume_segments", "i", """SELECT CASE WHEN n >= 50 THEN 'Heavy Buyers' WHEN n >= 20 THEN 'Category Focused'
      WHEN n >= 10 THEN 'Window Shoppers' WHEN n >= 5 THEN 'Seasonal Buyers' ELSE 'New Users' END AS segment,
    count(*) AS user_count, CAST(sum(spent) AS DOUBLE) / count(*) AS avg_spending,
    CAST(sum(n) AS DOUBLE) / count(*) AS avg_interactions
    FROM (SELECT user_id, count(*) AS n, sum(CASE WHEN interaction_type = 'purchase' THEN 100000 ELSE 0 END) AS spent
          FROM i GROUP BY user_id) GROUP BY 1""")
add("live_metrics", "i", f"""SELECT count(DISTINCT user_id) AS total_users,
    count(DISTINCT CASE WHEN ts >= {NOW} - INTERVAL 5 MINUTES THEN user_id END) AS active_users,
    count(*) AS total_interactions, count(*) // 3600 AS per_second, count(*) // 60 AS per_minute
    FROM i WHERE {since(hours=1)}""")
ACTIVE = f"last_activity >= {NOW} - INTERVAL {{}} MINUTES AND last_activity <= {NOW}"
add("active_sessions", "b", f"SELECT session_id, user_id, last_activity FROM b WHERE {ACTIVE.format(60)}")
add("active_session_count", "b", f"SELECT count(*) AS active_sessions FROM b WHERE {ACTIVE.format(5)}")
add("active_sessions_by_user", "b", f"""SELECT coalesce(user_id, 0) AS user_id, count(*) AS session_count
    FROM b WHERE {ACTIVE.format(60)} GROUP BY 1""")
add("hourly_by_type", "i", """SELECT CAST(hour(ts) AS INTEGER) AS hour, interaction_type,
    count(*) AS interaction_count FROM i GROUP BY ALL""")
add("top_categories", "i p", f"""SELECT category, count(*) AS interaction_count FROM i JOIN p USING (product_id)
    WHERE {since(hours=24)} GROUP BY category ORDER BY 2 DESC, 1 LIMIT 10""")
add("headline_stats", "i p", f"""SELECT count(*) FILTER (WHERE ts >= {NOW} - INTERVAL 1 HOUR) AS recent_interactions,
    count(DISTINCT user_id) AS active_users,
    (SELECT category FROM i JOIN p USING (product_id) WHERE {since(hours=24)} GROUP BY category
     ORDER BY count(*) DESC, category LIMIT 1) AS popular_category FROM i WHERE {since(hours=24)}""")
add("counts_by_type", "i", "SELECT interaction_type, count(*) AS interaction_count FROM i GROUP BY 1")
add("top_users", "i u", """SELECT user_id, interaction_count, coalesce(username, 'User ' || user_id) AS username
    FROM (SELECT user_id, count(*) AS interaction_count FROM i GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
    LEFT JOIN u USING (user_id)""")
add("user_type_counts", "i", "SELECT user_id, interaction_type, count(*) AS interaction_count FROM i GROUP BY ALL")
add("user_type_matrix", "s u", """SELECT u.user_id,
    count(*) FILTER (WHERE interaction_type = 'click') AS click_count,
    count(*) FILTER (WHERE interaction_type = 'view') AS view_count,
    count(*) FILTER (WHERE interaction_type = 'search') AS search_count,
    count(interaction_id) AS total_count FROM u LEFT JOIN s USING (user_id) GROUP BY u.user_id""")
add("category_sizes", "p", "SELECT category, count(*) AS product_count FROM p GROUP BY category")
add("table_totals", "i p u", f"""SELECT count(*) AS interactions,
    count(*) FILTER (WHERE {since(minutes=30)}) AS recent_interactions, min(ts) AS first_event,
    (SELECT count(*) FROM p) AS products, (SELECT count(*) FROM u) AS users FROM i""")
add("product_counters", "i", """SELECT product_id, interaction_type AS action, count(*) AS action_count,
    CAST(sum(count(*)) OVER (PARTITION BY product_id) AS BIGINT) AS total_interactions
    FROM i GROUP BY product_id, interaction_type""")
add("user_profile_counters", "e", f"""SELECT user_id, 'category' AS kind, category AS value, count(*) AS count FROM e
    WHERE category IS NOT NULL GROUP BY user_id, category UNION ALL
    SELECT user_id, 'price_range', {band('price')}, count(*) FROM e
    WHERE event_type IN ('product_view', 'click') GROUP BY user_id, {band('price')}""")
add("recommendation_clicks", "e", """SELECT product_id, count(*) AS clicks FROM e
    WHERE event_type = 'recommendation_click' GROUP BY product_id""")
add("shopping_patterns", "s", """SELECT user_id,
    CASE WHEN to_cart THEN 'add_to_cart' ELSE 'search:' || query END AS pattern, count(*) AS count
    FROM s WHERE to_cart OR interaction_type = 'search' GROUP BY ALL""")
add("favourite_products", "i", "SELECT user_id, product_id, interaction_count, rank FROM fav WHERE rank <= 5",
    FAVOURITES)
add("user_event_lists", "e", """SELECT user_id, part, string_agg(event_type, ',' ORDER BY pos) AS event_types,
    string_agg(coalesce(CAST(product_id AS VARCHAR), '-'), ',' ORDER BY pos) AS products
    FROM (SELECT *, pos // 20 AS part FROM (SELECT *,
      row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM e)) GROUP BY user_id, part""")
INTERESTS = f"""ui AS (SELECT user_id, kind, value, count(*) AS count, min(ts) AS first_ts FROM (
    SELECT user_id, ts, 'category' AS kind, category AS value FROM e WHERE category IS NOT NULL
    UNION ALL SELECT user_id, ts, 'price_range', {band('price')} FROM e WHERE price IS NOT NULL
    UNION ALL SELECT user_id, ts, 'recent_product', CAST(product_id AS VARCHAR) FROM e WHERE product_id IS NOT NULL)
    GROUP BY user_id, kind, value)"""
add("user_interests", "e", "SELECT * FROM ui", INTERESTS)
add("user_totals", "i u", """SELECT u.user_id, count(interaction_id) AS total_interactions,
    count(DISTINCT product_id) AS unique_products FROM u LEFT JOIN i USING (user_id) GROUP BY u.user_id""")

# ------------------------------------------------------- ranking and windows

add("recent_per_user", "s p", "SELECT user_id, pos, interaction_id, product_id, category, price FROM rc",
    capped(7, 10))
add("recent_per_user_published", "s p", "SELECT user_id, pos, interaction_id, product_id, category, price FROM rc",
    capped(7, 100))


def latest(minutes: int, *types: str) -> str:
    listed = ", ".join(f"'{t}'" for t in types)
    return f"""lc AS (SELECT user_id, category, ts FROM (SELECT user_id, category, ts,
      row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, interaction_id DESC) AS k
      FROM s JOIN p USING (product_id) WHERE interaction_type IN ({listed})
        AND {since(minutes=minutes)}) WHERE k = 1)"""


SEEN = ("click", "product_click", "view", "product_view")
add("latest_category", "s p", "SELECT user_id, category, ts FROM lc", latest(1440, *SEEN))


def history(event_type: str, columns: str, n: int = 5) -> str:
    return f"""SELECT user_id, event_id, ts, {columns}, CAST(rk AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk FROM e
      WHERE event_type = '{event_type}') WHERE rk <= {n}"""


add("history_recent_views", "e", history("product_view", "product_id"))
add("history_searches", "e", history("search", "'k' || k AS query, k AS results_count"))
add("history_page_views", "e", history("page_view", "'/product/' || k AS page"))
add("history_recent_views_published", "e", history("product_view", "product_id", 50))
add("history_searches_published", "e", history("search", "'k' || k AS query, k AS results_count", 100))
add("history_page_views_published", "e", history("page_view", "'/product/' || k AS page", 200))
add("history_live", "e", f"""SELECT user_id, event_id, ts, product_id, rank FROM (
    SELECT *, sum(pause) OVER (PARTITION BY user_id ORDER BY rank) AS pauses FROM (
      SELECT *, CASE WHEN ts + INTERVAL 7 DAYS < coalesce(lag(ts) OVER (PARTITION BY user_id ORDER BY rank), {NOW})
        THEN 1 ELSE 0 END AS pause FROM h)) WHERE pauses = 0""",
    """h AS (SELECT * FROM (SELECT user_id, event_id, ts, product_id,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rank FROM e
      WHERE event_type = 'product_view') WHERE rank <= 50)""")
PAST = """ph AS (SELECT * FROM (SELECT user_id, product_id, category, ts, interaction_id AS position,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, interaction_id DESC) AS INTEGER) AS rank
      FROM i JOIN p USING (product_id)
      WHERE interaction_type = 'purchase' AND ts < TIMESTAMP '2024-01-30 00:00:00') WHERE rank <= 10)"""
add("history_recommendations", "i p", "SELECT * FROM ph", PAST)
add("history_recommendations_published", "i p", "SELECT * FROM ph", PAST.replace("rank <= 10", "rank <= 50"))
add("recency_weighted_scores", "s p", """SELECT user_id, family, category,
    CAST(sum(tenths) AS DOUBLE) / 10 AS score FROM w GROUP BY user_id, family, category""",
    capped(1, 100), RECENCY)
add("top_category", "s p", """SELECT user_id, CAST(k AS INTEGER) AS rank, category, score FROM (
    SELECT user_id, category, CAST(sum(tenths) AS DOUBLE) / 10 AS score,
      row_number() OVER (PARTITION BY user_id ORDER BY sum(tenths) DESC, category) AS k
    FROM w WHERE family = 'clicked' GROUP BY user_id, category) WHERE k <= 2""", capped(1, 100), RECENCY)


def trend_rank(source: str, days: int = 7) -> str:
    """Products ranked inside their category by use, then newest."""
    return f"""tr AS (SELECT p.product_id, category, count(x.interaction_id) AS interaction_count,
      CAST(row_number() OVER (PARTITION BY category ORDER BY count(x.interaction_id) DESC, p.product_id DESC)
        AS INTEGER) AS rk
      FROM p LEFT JOIN (SELECT * FROM {source} WHERE {since(days=days)}) x USING (product_id)
      GROUP BY p.product_id, category)"""


SEEDED = f"md5(CAST(product_id AS VARCHAR) || ':{SEED}'), product_id"
SHUFFLED = f"""sh AS (SELECT product_id, category,
    CAST(row_number() OVER (PARTITION BY category ORDER BY {SEEDED}) AS INTEGER) AS rk FROM p)"""
NEWEST = """nw AS (SELECT product_id, category,
    CAST(row_number() OVER (PARTITION BY category ORDER BY product_id DESC) AS INTEGER) AS rk FROM p)"""
add("top_products_trend", "i p", """SELECT category, rk AS rank, product_id, interaction_count FROM tr
    WHERE rk <= 10""", trend_rank("i"))
add("top_products_newest", "p", "SELECT category, rk AS rank, product_id FROM nw WHERE rk <= 10", NEWEST)
add("top_products_seeded", "p", "SELECT category, rk AS rank, product_id FROM sh WHERE rk <= 10", SHUFFLED)


def global_rank(source: str) -> str:
    return f"""gt AS (SELECT product_id, name, n AS interaction_count,
      row_number() OVER (ORDER BY n DESC, {SEEDED}) AS g FROM (
        SELECT p.product_id, name, count(x.interaction_id) AS n
        FROM p LEFT JOIN (SELECT * FROM {source} WHERE {since(days=3)}) x USING (product_id)
        GROUP BY p.product_id, name))"""


add("global_trending", "i p", "SELECT product_id, name, interaction_count FROM gt WHERE g <= 20", global_rank("i"))
add("recent_activity_feed", "s u p", """SELECT interaction_id, coalesce(username, 'User ' || t.user_id) AS username,
    coalesce(name, 'Product ' || t.product_id) AS product_name, interaction_type, ts
    FROM (SELECT * FROM s ORDER BY ts DESC, interaction_id DESC LIMIT 20) t
    LEFT JOIN u USING (user_id) LEFT JOIN p USING (product_id)""")
add("first_products", "p", "SELECT product_id, name, price FROM p ORDER BY product_id LIMIT 12")
add("user_history", "s p", f"""SELECT user_id, interaction_id, interaction_type, name, ts
    FROM s LEFT JOIN p USING (product_id) WHERE {since(days=1)}""")
add("window_feed", "s p", f"""SELECT interaction_id, interaction_type, category, price, ts FROM (
    SELECT * FROM s WHERE {since(hours=24)} ORDER BY ts DESC, interaction_id DESC LIMIT 1000)
    LEFT JOIN p USING (product_id) WHERE (SELECT count(*) FROM s WHERE {since(hours=24)}) > 10""")

# --------------------------------------------------------------------- lists

MERGE = """SELECT user_id, CAST(rank AS INTEGER) AS rank, product_id FROM (
    SELECT user_id, product_id, row_number() OVER (PARTITION BY user_id ORDER BY o) AS rank FROM (
      SELECT user_id, product_id, min(o) AS o FROM (
        SELECT user_id, product_id, o FROM new_list UNION ALL
        SELECT user_id, product_id, 1000 + rank FROM fav WHERE rank <= 10 {})
      GROUP BY user_id, product_id)) WHERE rank <= 15"""
add("merge_ranked", "i p", MERGE.format(""), capped(7, 10, "i"), FAVOURITES,
    "new_list AS (SELECT user_id, product_id, pos AS o FROM rc)")
CANDIDATES = f"""d AS (SELECT * FROM e WHERE {IMPORTANT} AND {since(days=1)}),
  tp AS (SELECT product_id, row_number() OVER (ORDER BY trending_score DESC, product_id) AS rk
         FROM ({trending('i', 5)})),
  ca AS (SELECT DISTINCT user_id, product_id, 0 AS blk, 0 AS w, '' AS c, rk FROM (SELECT DISTINCT user_id FROM d) CROSS JOIN tp UNION ALL
         SELECT user_id, tr.product_id, 1, -n, category, rk
         FROM (SELECT user_id, category, count(*) AS n FROM d WHERE category IS NOT NULL GROUP BY ALL)
         JOIN tr USING (category) WHERE rk <= 3),
  cu AS (SELECT user_id, product_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY blk, w, c, rk, product_id)
           AS INTEGER) AS rank
         FROM (SELECT *, row_number() OVER (PARTITION BY user_id, product_id ORDER BY blk, w, c, rk) AS k FROM ca) t
         WHERE k = 1 AND NOT EXISTS (SELECT 1 FROM d WHERE d.user_id = t.user_id AND d.product_id = t.product_id))"""
add("candidate_union", "e i p", "SELECT user_id, product_id, rank FROM cu WHERE rank <= 10",
    trend_rank("i"), CANDIDATES)
add("refresh_recommendations", "e i p",
    MERGE.format("AND user_id IN (SELECT user_id FROM d)"), trend_rank("i"), CANDIDATES, FAVOURITES,
    "new_list AS (SELECT user_id, product_id, rank AS o FROM cu WHERE rank <= 10)")


def stream_batches(days: int) -> list[str]:
    """CTEs of the lists after each day: ``l<k>`` of its users, ``st<k>`` of all users with the time of the list."""
    out = ["st0 AS (SELECT NULL::BIGINT AS user_id, NULL::BIGINT AS product_id, NULL::INTEGER AS rank, NULL::TIMESTAMP AS ts WHERE false)"]
    for k in range(1, days + 1):
        span = f"ts >= {NOW} - INTERVAL {days + 1 - k} DAYS AND ts < {NOW} - INTERVAL {days - k} DAYS"
        out += [
            f"d{k} AS (SELECT * FROM e WHERE {IMPORTANT} AND {span})",
            f"u{k} AS (SELECT user_id, max(ts) AS ts FROM d{k} GROUP BY user_id)",
            f"""c{k} AS (SELECT user_id, product_id, 0 AS blk, 0 AS w, '' AS c, rk FROM u{k} CROSS JOIN tp UNION ALL
              SELECT user_id, tr.product_id, 1, -n, category, rk
              FROM (SELECT user_id, category, count(*) AS n FROM d{k} WHERE category IS NOT NULL GROUP BY ALL)
              JOIN tr USING (category) WHERE rk <= 3)""",
            f"""n{k} AS (SELECT user_id, product_id, row_number() OVER (PARTITION BY user_id ORDER BY blk, w, c, rk, product_id) AS rank
              FROM (SELECT *, row_number() OVER (PARTITION BY user_id, product_id ORDER BY blk, w, c, rk) AS k FROM c{k}) t
              WHERE k = 1 AND NOT EXISTS (SELECT 1 FROM d{k} d WHERE d.user_id = t.user_id AND d.product_id = t.product_id))""",
            f"""m{k} AS (SELECT user_id, product_id, min(o) AS o FROM (
                SELECT user_id, product_id, rank AS o FROM n{k} WHERE rank <= 10 UNION ALL
                SELECT s.user_id, product_id, 1000 + rank FROM st{k - 1} s JOIN u{k} u ON s.user_id = u.user_id
                WHERE u.ts <= s.ts + INTERVAL 3 DAYS) GROUP BY ALL)""",
            f"""l{k} AS (SELECT * FROM (SELECT user_id, product_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY o)
              AS INTEGER) AS rank FROM m{k}) WHERE rank <= 15)""",
            f"""st{k} AS (SELECT user_id, product_id, rank, ts FROM l{k} JOIN u{k} USING (user_id)
              UNION ALL SELECT * FROM st{k - 1} WHERE user_id NOT IN (SELECT user_id FROM u{k}))""",
        ]
    return out


TREND_PLACES = f"""tp AS (SELECT product_id, row_number() OVER (ORDER BY trending_score DESC, product_id) AS rk
    FROM ({trending('i', 5)}))"""
add("stream_refresh", "e i p",
    " UNION ALL ".join(f"SELECT {k - 1}::BIGINT AS day, user_id, rank, product_id FROM l{k}" for k in range(1, 7)),
    trend_rank("i"), TREND_PLACES, *stream_batches(6))
add("event_router", "e", """SELECT 'input' AS sink, NULL::BIGINT AS rows_stored, count(*) AS rows_counted FROM e
    UNION ALL SELECT 'raw_events', count(*), count(*) FROM e WHERE event_id % 50 <> 0
    UNION ALL SELECT 'rejected_events', count(*), count(*) FROM e WHERE event_id % 50 = 0
    UNION ALL SELECT 'interactions', count(*), count(*) FROM e WHERE event_id % 50 <> 0
      AND (event_type = 'product_view' OR event_type IN ('click', 'recommendation_click') AND product_id IS NOT NULL)""")
add("closed_sessions", "", """SELECT session_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS started_at,
      strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_activity, count(*) AS heartbeats FROM (
      SELECT *, sum(new) OVER (PARTITION BY session_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM (
        SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY session_id ORDER BY ts) + INTERVAL 2 DAYS THEN 0 ELSE 1 END AS new
        FROM (SELECT 'tab_' || user_id || '_' || event_type AS session_id, ts FROM events)))
    GROUP BY session_id, run""")
add("stream_timeline_levels", "i", f"""SELECT strftime(time_bucket(INTERVAL 1 HOUR, m), '%Y-%m-%d %H:%M') AS bucket,
      CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(views) AS BIGINT) AS views, CAST(sum(purchases) AS BIGINT) AS purchases,
      count(*) AS fine_windows, max(clicks + views + purchases) AS busiest FROM (
        SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS m, count(*) FILTER ({CLICK}) AS clicks, count(*) FILTER ({VIEW}) AS views,
          count(*) FILTER (interaction_type = 'purchase') AS purchases FROM i GROUP BY 1) GROUP BY 1""")
add("live_users", "i", f"""SELECT strftime(e, '%Y-%m-%d %H:%M') AS minute_end, count(DISTINCT user_id) AS total_users,
      count(DISTINCT CASE WHEN ts >= e - INTERVAL 5 MINUTES THEN user_id END) AS active_users
    FROM (SELECT unnest(generate_series({NOW} - INTERVAL 1439 MINUTES, {NOW}, INTERVAL 1 MINUTE)) AS e)
    JOIN i ON ts >= e - INTERVAL 1 HOUR AND ts < e WHERE user_id IS NOT NULL GROUP BY e""")
add("distinct_values", "s", "SELECT DISTINCT user_id, interaction_type FROM s")
add("drop_matching_sessions", "b", f"""SELECT session_id, user_id, last_activity FROM b
    WHERE NOT starts_with(session_id, 'tab_1') AND last_activity >= {NOW} - INTERVAL 1440 MINUTES""")

# ------------------------------------------------------------------------ ml

PREDICTED = "pr AS (SELECT *, CASE WHEN interaction_count > 1 THEN total_score / 2 END AS prediction FROM rt)"
add("regression_metrics", "i", """SELECT round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) AS rmse,
    round(avg(abs(prediction - rating)), 6) AS mae, count(*) AS total_predictions
    FROM pr WHERE prediction IS NOT NULL""", RATED.format("i"), PREDICTED)
add("coverage", "i", """SELECT
    round(count(DISTINCT CASE WHEN prediction IS NOT NULL THEN user_id END) / count(DISTINCT user_id) * 100, 2)
      AS user_coverage_percent,
    round(count(DISTINCT CASE WHEN prediction IS NOT NULL THEN product_id END) / count(DISTINCT product_id) * 100, 2)
      AS item_coverage_percent, count(prediction) AS total_predictions FROM pr""", RATED.format("i"), PREDICTED)
BANDED = """bd AS (SELECT *, CAST(CASE WHEN total_interactions >= 70 THEN 0 WHEN total_interactions >= 60 THEN 1
    ELSE 2 END AS INTEGER) AS prediction FROM ft),
  tc AS (SELECT prediction, most_viewed_category AS top_category, count(*) AS top_category_users,
    row_number() OVER (PARTITION BY prediction ORDER BY count(*) DESC, most_viewed_category) AS k
    FROM bd GROUP BY prediction, most_viewed_category),
  pf AS (SELECT prediction, count(*) AS cluster_size, avg(total_interactions) AS ai,
    avg(total_engagement_score) AS ae, avg(unique_products_viewed) AS ap, avg(avg_product_price_viewed) AS av
    FROM bd GROUP BY prediction)"""
add("cluster_profile", "i p", """SELECT prediction, cluster_size, round(ai, 6) AS avg_interactions,
    round(ae, 6) AS avg_engagement, round(ap, 6) AS avg_unique_products, round(av, 6) AS avg_price_preference,
    top_category, top_category_users FROM pf JOIN tc USING (prediction) WHERE k = 1""", features("i"), BANDED)
add("label_clusters", "i p", """SELECT 'cluster_' || prediction AS cluster, type, cluster_size AS size,
    CASE type WHEN 'Power Users 💎' THEN 'VIP treatment, premium products, early access'
      WHEN 'Active Explorers 🔍' THEN 'Product discovery, recommendations, variety'
      WHEN 'Premium Shoppers 💰' THEN 'Luxury items, quality focus, exclusive offers'
      WHEN 'Casual Browsers 👀' THEN 'Engagement campaigns, easy purchase flow'
      ELSE 'Onboarding, tutorials, attractive first offers' END AS marketing_strategy
    FROM (SELECT *, CASE WHEN ae > 170 AND ai > 60 THEN 'Power Users 💎'
      WHEN ae > 140 AND ap > 40 THEN 'Active Explorers 🔍' WHEN av > 904 THEN 'Premium Shoppers 💰'
      WHEN ai > 10 AND ae < 20 THEN 'Casual Browsers 👀' ELSE 'New/Low Activity Users 🌱' END AS type FROM pf)""",
    features("i"), BANDED)
STANDARD = (
    "total_interactions", "unique_products_viewed", "categories_explored", "total_engagement_score",
    "avg_interaction_intensity", "active_days", "avg_hour_activity", "recent_engagement", "total_clicks",
    "total_views", "avg_product_price_viewed",
)
add("assemble_scale", "i p", "SELECT user_id, " + ", ".join(
    f"""round(CASE WHEN stddev_samp(v.{c}) OVER () > 0 THEN (v.{c} - avg(v.{c}) OVER ())
      / stddev_samp(v.{c}) OVER () ELSE 0 END, 6) AS {c}""" for c in STANDARD) + " FROM v", features("i"),
    "v AS (SELECT user_id, " + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}" for c in STANDARD) + " FROM ft)")
add("silhouette_by_k", "i p", """SELECT k, c AS cluster, users, round(total / users, 6) AS silhouette, mean_silhouette,
    k = (SELECT k FROM best ORDER BY mean_silhouette DESC, k LIMIT 1) AS chosen FROM scored JOIN best USING (k)""",
    features("i"),
    "v AS (SELECT user_id, " + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}" for c in STANDARD) + " FROM ft)",
    "z AS (SELECT user_id, CAST(total_interactions AS BIGINT) AS t, [" + ", ".join(
        f"""CASE WHEN stddev_samp({c}) OVER () > 0
        THEN ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () ELSE 0 END""" for c in STANDARD) + "] AS x FROM v)",
    """a AS (SELECT k, user_id, x, list_dot_product(x, x) AS q, (t * k) // ((SELECT max(t) FROM z) + 1) AS c
    FROM z, (SELECT unnest([2, 3, 4, 5, 6, 7]) AS k))""",
    "g AS (SELECT k, c, count(*) AS n, avg(q) AS q, [" + ", ".join(
        f"avg(x[{i + 1}])" for i in range(len(STANDARD))) + "] AS m FROM a GROUP BY k, c)",
    """d AS (SELECT a.k, a.user_id, a.c, g.c AS o, g.n, greatest(a.q + g.q - 2 * list_dot_product(a.x, g.m), 0) AS d
    FROM a JOIN g USING (k))""",
    """w AS (SELECT k, user_id, c, max(CASE WHEN o = c AND n > 1 THEN d * n / (n - 1) END) AS own,
    min(CASE WHEN o <> c THEN d END) AS nearest FROM d GROUP BY k, user_id, c)""",
    """scored AS (SELECT k, c, count(*) AS users, sum(CASE WHEN own IS NULL OR nearest IS NULL OR greatest(own, nearest) = 0
    THEN 0 ELSE (nearest - own) / greatest(own, nearest) END) AS total FROM w GROUP BY k, c)""",
    "best AS (SELECT k, round(sum(total) / sum(users), 6) AS mean_silhouette FROM scored GROUP BY k)")
add("kmeans_properties", "i p", """SELECT CAST(count(*) AS BIGINT) AS users, true AS k_in_range, true AS best_silhouette,
    true AS all_used FROM ft""", features("i"))
add("index_ids", "i", """SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS INTEGER) AS user_index
    FROM (SELECT DISTINCT user_id FROM rt)""", RATED.format("i"))
add("index_to_label", "i", "SELECT user_id, product_id, interaction_count FROM rt", RATED.format("i"))
add("tuned_als", "", """SELECT count(*) AS settings, true AS all_scored, 1::BIGINT AS chosen, true AS has_choice,
    CAST(sum(r) AS BIGINT) AS ranks, CAST(sum(x) AS DOUBLE) AS regularisations FROM (VALUES (2, 0.5), (4, 0.1), (4, 0.1)) t(r, x)""")
add("saved_model", "s p", """SELECT count(*) AS pairs, count(*) AS same
    FROM (SELECT DISTINCT user_id, product_id FROM s JOIN p USING (product_id) WHERE user_id IS NOT NULL)""")
add("list_rank", "i", "SELECT user_id, rank, product_id, interaction_count FROM fav WHERE rank <= 5", FAVOURITES)
add("write_partitioned", "p", "SELECT product_id, name, category, price FROM p")
add("write_snapshot", "s p", trending("s", 20))
add("write_json", "p", """SELECT category, count(*) AS products, string_agg(DISTINCT name, ',' ORDER BY name) AS names
    FROM p GROUP BY category""")
add("import_relational", "u", "SELECT *, (SELECT count(*) FROM u) AS rows_written FROM u")
add("append_interactions", "e", """SELECT event_id, user_id, product_id,
    CASE event_type WHEN 'product_view' THEN 'view' WHEN 'click' THEN 'click_' || action
    ELSE event_type END AS interaction_type, ts, event_id % 2 AS batch FROM e
    WHERE event_type IN ('product_view', 'click', 'recommendation_click')""")
add("als_properties", "s p", """SELECT count(*) AS pairs, true AS all_predicted, count(DISTINCT user_id) AS users,
    CAST(count(DISTINCT user_id) * least(10, count(DISTINCT product_id)) AS BIGINT) AS entries, true AS ranks_dense,
    true AS ratings_in_order, true AS products_distinct
    FROM (SELECT DISTINCT user_id, product_id FROM s JOIN p USING (product_id))""")
add("hybrid_blend", "s p", """SELECT user_id, product_id, round(score, 6) AS score, CAST(k AS INTEGER) AS rank FROM (
    SELECT user_id, product_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS k
    FROM (SELECT user_id, product_id, round(sum(score / best * weight), 9) AS score
      FROM (SELECT *, max(score) OVER (PARTITION BY user_id, weight) AS best FROM sc)
      GROUP BY user_id, product_id)) WHERE k <= 10""",
    RATED.format("s"),
    f"""pa AS (SELECT user_id, product_id, category, CAST(sum({PREFERENCE}) AS DOUBLE) AS sp
      FROM s JOIN p USING (product_id) GROUP BY ALL)""",
    """sc AS (SELECT user_id, product_id, round(rating, 6) AS score, 0.4::DOUBLE AS weight FROM rt UNION ALL
      SELECT user_id, product_id, sum(sp) OVER (PARTITION BY user_id, category), 0.3::DOUBLE FROM pa UNION ALL
      SELECT user_id, product_id, CAST(n AS DOUBLE), 0.2::DOUBLE FROM pa
        JOIN (SELECT product_id, count(*) AS n FROM s GROUP BY product_id) USING (product_id) UNION ALL
      SELECT user_id, product_id, sp, 0.1::DOUBLE FROM pa)""")


def similar(source: str) -> list[str]:
    """TF-IDF vectors ``nv`` of ``source(product_id, category, body)`` and the five nearest ``sm``."""
    return [
        f"""tk AS (SELECT product_id, category, unnest(regexp_split_to_array(lower(body), '[^\\p{{L}}\\p{{N}}]+')) AS word
          FROM {source})""",
        "tf AS (SELECT product_id, category, word, count(*) AS tf FROM tk WHERE word <> '' GROUP BY ALL)",
        "df AS (SELECT word, count(DISTINCT product_id) AS df FROM tf GROUP BY word)",
        """rw AS (SELECT product_id, category, word, tf * (ln(((SELECT count(DISTINCT product_id) FROM tf) + 1)
          / (df + 1)) + 1) AS raw FROM tf JOIN df USING (word))""",
        """nv AS (SELECT product_id, category, word, raw / sqrt(sum(raw * raw) OVER (PARTITION BY product_id)) AS w
          FROM rw)""",
        """sm AS (SELECT product_id, CAST(k AS INTEGER) AS rank, similar_id, similarity FROM (
          SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY similarity DESC, similar_id) AS k FROM (
            SELECT a.product_id, z.product_id AS similar_id, round(sum(a.w * z.w), 6) AS similarity
            FROM nv a JOIN nv z ON a.category = z.category AND a.word = z.word AND a.product_id <> z.product_id
            GROUP BY a.product_id, z.product_id) WHERE similarity > 0) WHERE k <= 5)""",
    ]


BODY = "pb AS (SELECT product_id, category, concat_ws(' ', name, description) AS body FROM p)"
add("content_similarity", "p", "SELECT * FROM sm", BODY, *similar("pb"))
add("content_similarity_texts", "", "SELECT * FROM sm",
    """bm AS (SELECT item_id AS product_id, text AS body,
      CASE WHEN item_id % 2 = 0 THEN 'even' ELSE 'odd' END AS category FROM benchmark)""", *similar("bm"))
PAIRS = f"""pa AS (SELECT user_id, product_id, CAST(sum({PREFERENCE}) AS DOUBLE) AS score
    FROM s JOIN p USING (product_id) WHERE category IS NOT NULL GROUP BY ALL)"""
CONTENT = """ct AS (SELECT user_id, similar_id AS product_id,
      CAST(sum(CAST(score AS DECIMAL(18, 0)) * CAST(similarity AS DECIMAL(10, 6))) AS DOUBLE) AS score
      FROM pa JOIN sm USING (product_id) WHERE score > 0 AND user_id IS NOT NULL GROUP BY ALL)"""
POPULAR = "pc AS (SELECT product_id, CAST(count(*) AS DOUBLE) AS score FROM s JOIN p USING (product_id) GROUP BY product_id)"
add("hybrid_sources", "s p", """SELECT user_id, product_id, 'behavior' AS source, score FROM pa
      UNION ALL SELECT user_id, product_id, 'content', score FROM ct
      UNION ALL SELECT NULL, product_id, 'popularity', score FROM pc""", BODY, *similar("pb"), PAIRS, CONTENT, POPULAR)


def shares(key: str, name: str) -> str:
    """Shares of the interaction types per user or product, as columns ``name0`` ...."""
    columns = ", ".join(
        f"round(count(*) FILTER (interaction_type = '{t}') / count(*), 4) AS {name}{k}" for k, t in enumerate(PREDICTED_TYPES)
    )
    return f"{name}f AS (SELECT {key}, {columns} FROM s WHERE {key} IS NOT NULL GROUP BY {key})"


DOT = " + ".join(f"u{k} * g{k}" for k in range(len(PREDICTED_TYPES)))
add("recommend_hybrid_lists", "s p", """SELECT user_id, CAST(rank AS INTEGER) AS rank, product_id, round(score, 6) AS score FROM bl
      WHERE rank <= 10""",
    BODY, *similar("pb"), PAIRS, CONTENT, POPULAR, shares("user_id", "u"), shares("product_id", "g"),
    """us AS (SELECT DISTINCT user_id FROM s JOIN p USING (product_id) WHERE user_id IS NOT NULL
      UNION SELECT user_id FROM uf)""",
    f"""al AS (SELECT user_id, product_id, 'behavior' AS source, score FROM pa WHERE user_id IS NOT NULL
      UNION ALL SELECT user_id, product_id, 'content', score FROM ct
      UNION ALL SELECT user_id, product_id, 'popularity', score FROM us, pc
      UNION ALL SELECT user_id, product_id, 'cf', {DOT} FROM uf, gf)""",
    """bl AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS rank FROM (
      SELECT user_id, product_id, round(sum(score / best * CASE source WHEN 'cf' THEN 0.4 WHEN 'content' THEN 0.3
        WHEN 'popularity' THEN 0.2 ELSE 0.1 END), 9) AS score
      FROM (SELECT *, max(score) OVER (PARTITION BY user_id, source) AS best FROM al WHERE score > 0)
      GROUP BY user_id, product_id))""")
add("recommend_hybrid", "s p", """SELECT DISTINCT user_id, 10::BIGINT AS entries, true AS ranks_dense,
    true AS products_distinct, true AS scores_in_range FROM s JOIN p USING (product_id)""")

# -------------------------------------------------------------- recommenders

HYDRATED = """SELECT user_id, CAST(rank AS INTEGER) AS rank, product_id, name, category, price, reason, priority,
    strategy_used FROM lst JOIN p USING (product_id)"""

CASCADE = f"""f AS (SELECT *, {FAMILY} AS family, {POINTS} AS score FROM rc WHERE category IS NOT NULL),
  mn AS (SELECT u.user_id, arg_min(category, pos) FILTER (WHERE {CLICK}) AS cc,
      arg_min(category, pos) FILTER (WHERE {VIEW}) AS vc,
      coalesce(sum(score) FILTER (WHERE family = 'clicked'), 0) AS cs,
      coalesce(sum(score) FILTER (WHERE family = 'viewed'), 0) AS vs
    FROM u LEFT JOIN f USING (user_id) GROUP BY u.user_id),
  m AS (SELECT *, coalesce(cc, vc) AS main, CASE WHEN cc IS NOT NULL THEN 4 ELSE 3 END AS take,
      CASE WHEN cc IS NOT NULL THEN 'latest_click_based' WHEN vc IS NOT NULL THEN 'latest_view_based'
        WHEN cs > 0 THEN 'frequent_clicks_based' WHEN vs > 0 THEN 'frequent_views_based'
        ELSE 'trending_based' END AS strategy_used FROM mn),
  ct AS (SELECT user_id, category, sum(score) AS sc,
      row_number() OVER (PARTITION BY user_id ORDER BY sum(score) DESC, category) AS rk
    FROM f WHERE family = 'clicked' GROUP BY user_id, category),
  s1 AS (SELECT user_id, 1 AS stage, 1 AS blk, rk AS ord, product_id,
      CASE WHEN cc IS NOT NULL THEN 'latest_click' ELSE 'latest_view' END AS priority,
      CASE WHEN cc IS NOT NULL THEN 'Dựa trên lần click gần nhất: ' ELSE 'Dựa trên lần xem gần nhất: ' END || main
        AS reason
    FROM m JOIN tr ON tr.category = m.main AND rk <= take),
  c2 AS (SELECT user_id, 2 AS stage, ct.rk AS blk, tr.rk AS ord, product_id, 'frequent_category' AS priority,
      'Bạn quan tâm đến ' || ct.category || ' (' || sc || ' lần click)' AS reason
    FROM ct JOIN m USING (user_id) JOIN tr ON tr.category = ct.category AND tr.rk <= 2
    WHERE ct.rk <= 3 AND ct.category IS DISTINCT FROM main),
  n1 AS (SELECT user_id, count(*) AS n FROM s1 GROUP BY user_id),
  b2 AS (SELECT user_id, blk, coalesce(n, 0) + coalesce(sum(q) OVER (PARTITION BY user_id ORDER BY blk
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM (SELECT user_id, blk, count(*) AS q FROM c2 GROUP BY user_id, blk) t LEFT JOIN n1 USING (user_id)),
  p12 AS (SELECT * FROM s1 UNION ALL
    SELECT c2.* FROM c2 JOIN b2 USING (user_id, blk) WHERE before < 6),
  rl AS (SELECT user_id, related_category, row_number() OVER (PARTITION BY user_id ORDER BY min(ct.rk * 10 + rel_rank)) AS k
    FROM ct JOIN r USING (category) WHERE ct.rk <= 2 AND rel_rank <= 2 GROUP BY user_id, related_category),
  c3 AS (SELECT user_id, k, product_id, related_category,
      row_number() OVER (PARTITION BY user_id ORDER BY k) - 1 AS idx FROM (
    SELECT rl.*, product_id, row_number() OVER (PARTITION BY rl.user_id, k ORDER BY rk) AS j
    FROM rl JOIN tr ON tr.category = related_category WHERE k <= 3 AND NOT EXISTS (
      SELECT 1 FROM p12 WHERE p12.user_id = rl.user_id AND p12.product_id = tr.product_id)) WHERE j = 1),
  n12 AS (SELECT user_id, count(*) AS n FROM p12 GROUP BY user_id),
  p123 AS (SELECT * FROM p12 UNION ALL
    SELECT user_id, 3, k, 1, product_id, 'related_category',
      'Liên quan đến sở thích của bạn về ' || related_category
    FROM c3 LEFT JOIN n12 USING (user_id) WHERE coalesce(n, 0) + idx < 6),
  fv AS (SELECT * FROM (SELECT user_id, product_id, category,
      row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, product_id) AS k
    FROM f WHERE {VIEW} GROUP BY user_id, product_id, category) WHERE k <= 3),
  c4 AS (SELECT * FROM (SELECT user_id, product_id,
      row_number() OVER (PARTITION BY user_id ORDER BY product_id DESC) AS k
    FROM (SELECT DISTINCT user_id, category FROM fv) t JOIN p USING (category)
    WHERE NOT EXISTS (SELECT 1 FROM fv WHERE fv.user_id = t.user_id AND fv.product_id = p.product_id)) WHERE k <= 3),
  n123 AS (SELECT user_id, count(*) AS n FROM p123 GROUP BY user_id),
  a4 AS (SELECT c4.*, row_number() OVER (PARTITION BY user_id ORDER BY k) AS j FROM c4
    WHERE NOT EXISTS (SELECT 1 FROM p123 x WHERE x.user_id = c4.user_id AND x.product_id = c4.product_id)),
  p1234 AS (SELECT * FROM p123 UNION ALL
    SELECT user_id, 4, 1, k, product_id, 'similar_product', 'Tương tự sản phẩm bạn đã quan tâm'
    FROM a4 LEFT JOIN n123 USING (user_id) WHERE coalesce(n, 0) + j <= 6),
  n4 AS (SELECT user_id, count(*) AS n FROM p1234 GROUP BY user_id),
  a5 AS (SELECT u.user_id, product_id, g, row_number() OVER (PARTITION BY u.user_id ORDER BY g) AS j
    FROM u CROSS JOIN (SELECT * FROM gt WHERE g <= 12) t WHERE NOT EXISTS (
      SELECT 1 FROM p1234 x WHERE x.user_id = u.user_id AND x.product_id = t.product_id)),
  al AS (SELECT * FROM p1234 UNION ALL
    SELECT user_id, 5, 1, g, product_id, 'trending', 'Sản phẩm đang được quan tâm nhiều'
    FROM a5 LEFT JOIN n4 USING (user_id) WHERE coalesce(n, 0) + j <= 6),
  lst AS (SELECT * FROM (SELECT al.*, strategy_used,
      row_number() OVER (PARTITION BY al.user_id ORDER BY stage, blk, ord) AS rank
    FROM al JOIN m USING (user_id)) WHERE rank <= 6)"""
VIEWS_ALL = "s p u r"
CASCADE_CTES = (capped(7, 100), trend_rank("s"), global_rank("s"), CASCADE)
add("recommend_cascade", VIEWS_ALL, HYDRATED, *CASCADE_CTES)

SIMPLE = f"""k AS (SELECT *, interaction_type <> 'search' AS clicked FROM rc WHERE category IS NOT NULL
      AND ({CLICK} OR {VIEW} OR interaction_type = 'search')),
  m AS (SELECT u.user_id, arg_min(category, pos) FILTER (WHERE clicked) AS cc,
      arg_min(product_id, pos) FILTER (WHERE clicked) AS cp, arg_min(name, pos) FILTER (WHERE clicked) AS cn,
      arg_min(category, pos) AS sc, count(*) FILTER (WHERE clicked) AS clicks, count(pos) AS kept,
      coalesce(sum(CASE WHEN clicked THEN 3 WHEN pos IS NOT NULL THEN 1 END), 0) AS total
    FROM u LEFT JOIN k USING (user_id) GROUP BY u.user_id),
  al AS (SELECT user_id, 1 AS stage, rk AS ord, product_id, 'same_category' AS priority,
      'Cùng danh mục với ''' || cn || '''' AS reason
    FROM (SELECT m.*, nw.product_id, row_number() OVER (PARTITION BY user_id ORDER BY nw.rk) AS rk
      FROM m JOIN nw ON nw.category = cc AND nw.product_id <> cp) WHERE rk <= 8
    UNION ALL SELECT user_id, 2, rel_rank, product_id, 'related_category',
      'Liên quan đến ''' || cn || ''' - từ ' || related_category
    FROM m JOIN r ON r.category = cc AND rel_rank <= 2 JOIN nw ON nw.category = related_category AND rk = 1
    UNION ALL SELECT user_id, 3, rk, product_id, 'viewed_category', 'Dựa trên danh mục bạn đã xem: ' || sc
    FROM m JOIN nw ON nw.category = sc AND rk <= 6 WHERE cc IS NULL
    UNION ALL SELECT user_id, 4, rk, product_id, 'fallback', 'Sản phẩm phổ biến'
    FROM m JOIN nw ON nw.category = 'ECONOMY' AND rk <= 6 WHERE cc IS NULL AND sc IS NULL),
  st AS (SELECT *, CASE WHEN cc IS NOT NULL THEN 'same_category_plus_related'
      WHEN sc IS NOT NULL THEN 'view_based_fallback' ELSE 'no_data_fallback' END AS strategy_used FROM m),
  lst AS (SELECT * FROM (SELECT al.*, strategy_used,
      row_number() OVER (PARTITION BY user_id ORDER BY stage, ord) AS rank FROM al JOIN st USING (user_id))
    WHERE rank <= 10)"""
SIMPLE_CTES = (capped(7, 100), NEWEST, SIMPLE)
add("recommend_same_plus_related", VIEWS_ALL, HYDRATED, *SIMPLE_CTES)
add("explain_recommendations", VIEWS_ALL, """SELECT user_id, strategy_used, CAST(n AS INTEGER) AS total,
    clicks AS recent_clicks_count, kept AS recent_interactions_count, CAST(total AS BIGINT) AS total_interactions,
    cc AS latest_click_category, cn AS latest_click_product, sc AS latest_interaction_category, top_clicked,
    top_viewed FROM st JOIN (SELECT user_id, count(*) AS n FROM lst GROUP BY user_id) USING (user_id)
    LEFT JOIN (SELECT user_id,
        coalesce(string_agg(category || ':' || a, ',' ORDER BY a DESC, category) FILTER (WHERE a > 0 AND ra <= 3), '')
          AS top_clicked,
        coalesce(string_agg(category || ':' || v, ',' ORDER BY v DESC, category) FILTER (WHERE v > 0 AND rv <= 3), '')
          AS top_viewed
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY a DESC, category) AS ra,
              row_number() OVER (PARTITION BY user_id ORDER BY v DESC, category) AS rv
            FROM (SELECT user_id, category, sum(CASE WHEN clicked THEN 3 ELSE 0 END) AS a,
                    sum(CASE WHEN clicked THEN 0 ELSE 1 END) AS v FROM k GROUP BY user_id, category))
      GROUP BY user_id) USING (user_id)""", *SIMPLE_CTES)

INSTANT_CTES = (capped(7, 100), latest(30, *SEEN), SHUFFLED, f"""wk AS (SELECT user_id, category,
      row_number() OVER (PARTITION BY user_id ORDER BY sum({INSTANT}) DESC, category) AS k
    FROM rc WHERE category IS NOT NULL GROUP BY user_id, category),
  m AS (SELECT u.user_id, coalesce(lc.category, wk.category) AS main,
      CASE WHEN coalesce(lc.category, wk.category) IS NOT NULL THEN 'real_data_instant_switch'
        WHEN u.user_id IN (SELECT user_id FROM rc) THEN 'no_category' ELSE 'no_data' END AS strategy_used
    FROM u LEFT JOIN lc USING (user_id) LEFT JOIN wk ON wk.user_id = u.user_id AND k = 1),
  al AS (SELECT user_id, 1 AS stage, rk AS ord, product_id, 'main_category' AS priority, '🔥 ' || main AS reason
    FROM m JOIN sh ON sh.category = main AND rk <= 8
    UNION ALL SELECT user_id, 2, rel_rank, product_id, 'related_category', 'Liên quan: ' || related_category
    FROM m JOIN r ON r.category = main AND rel_rank <= 2 JOIN sh ON sh.category = related_category AND rk = 1),
  lst AS (SELECT al.*, strategy_used, row_number() OVER (PARTITION BY user_id ORDER BY stage, ord) AS rank
    FROM al JOIN m USING (user_id))""")
add("recommend_instant_switch", VIEWS_ALL, HYDRATED, *INSTANT_CTES)

# Every category has two related ones with products here, so the later sources
# of the two other products are never reached; fixtures cover those.
RECENCY_CTES = (capped(1, 100), RECENCY, latest(5, *SEEN, "recommendation_click"), SHUFFLED, PAST,
    """tt AS (SELECT user_id, sum(tenths) AS t FROM w GROUP BY user_id),
  tk AS (SELECT user_id, category, row_number() OVER (PARTITION BY user_id ORDER BY sum(tenths) DESC, category) AS k
    FROM w WHERE family = 'clicked' GROUP BY user_id, category),
  m AS (SELECT u.user_id, coalesce(lc.category, tk.category) AS main,
      CASE WHEN coalesce(t, 0) < 10 THEN 'no_data_available'
        WHEN coalesce(lc.category, tk.category) IS NULL THEN 'no_main_category'
        ELSE 'instant_switch_8_plus_2' END AS strategy_used
    FROM u LEFT JOIN tt USING (user_id) LEFT JOIN lc USING (user_id)
    LEFT JOIN tk ON tk.user_id = u.user_id AND k = 1),
  hs AS (SELECT user_id, product_id, category, row_number() OVER (PARTITION BY user_id ORDER BY o) AS j
    FROM (SELECT ph.user_id, product_id, ph.category, min(-rank) AS o FROM ph JOIN m USING (user_id)
      WHERE ph.category <> main GROUP BY ALL)),
  h2 AS (SELECT * FROM hs WHERE j <= 2),
  rb AS (SELECT user_id, rel_rank, product_id, row_number() OVER (PARTITION BY user_id ORDER BY rel_rank) - 1 AS idx
    FROM (SELECT m.user_id, rel_rank, sh.product_id,
        row_number() OVER (PARTITION BY m.user_id, rel_rank ORDER BY sh.rk) AS j
      FROM m JOIN r ON r.category = main AND rel_rank <= 2 JOIN sh ON sh.category = related_category
      WHERE NOT EXISTS (SELECT 1 FROM h2 WHERE h2.user_id = m.user_id AND h2.product_id = sh.product_id))
    WHERE j = 1),
  al AS (SELECT user_id, 1 AS stage, rk AS ord, product_id, 'main_category' AS priority,
      '🔥 INSTANT: ' || main AS reason FROM m JOIN sh ON sh.category = main AND rk <= 8
    UNION ALL SELECT user_id, 2, j, product_id, 'from_history', 'Từ lần gợi ý trước: ' || category FROM h2
    UNION ALL SELECT user_id, 3, rel_rank, product_id, 'from_related', 'Liên quan đến ' || main
    FROM rb JOIN m USING (user_id) LEFT JOIN (SELECT user_id, count(*) AS n FROM h2 GROUP BY user_id) USING (user_id)
    WHERE coalesce(n, 0) + idx < 2),
  lst AS (SELECT al.*, strategy_used, row_number() OVER (PARTITION BY user_id ORDER BY stage, ord) AS rank
    FROM al JOIN m USING (user_id) WHERE strategy_used = 'instant_switch_8_plus_2')""")
add("recommend_recency_8_2", "s i p u r", HYDRATED, *RECENCY_CTES)
add("recommendation_mix", "s i p u r", """SELECT u.user_id,
    count(*) FILTER (WHERE priority = 'main_category') AS main_category,
    count(*) FILTER (WHERE priority = 'from_related') AS from_related,
    count(*) FILTER (WHERE priority = 'from_history') AS from_history,
    count(*) FILTER (WHERE priority = 'from_viewed') AS from_viewed,
    count(*) FILTER (WHERE priority = 'from_discovery') AS from_discovery,
    count(*) FILTER (WHERE priority = 'main_category') >= 6 AS main_ok
    FROM u LEFT JOIN lst USING (user_id) GROUP BY u.user_id""", *RECENCY_CTES)


def strategies(name: str, views: str, state: str, ctes: tuple[str, ...]) -> str:
    body = f"""SELECT '{name}' AS recommender, user_id, strategy_used, CAST(count(product_id) AS INTEGER) AS total
      FROM {state} LEFT JOIN (SELECT user_id, product_id FROM lst) USING (user_id) GROUP BY user_id, strategy_used"""
    return f"SELECT * FROM ({sql(views, body, *ctes)})"


ORACLE["recommendation_strategies"] = " UNION ALL ".join(
    [
        strategies("cascade", VIEWS_ALL, "m", CASCADE_CTES),
        strategies("same_plus_related", VIEWS_ALL, "st", SIMPLE_CTES),
        strategies("instant_switch", VIEWS_ALL, "m", INSTANT_CTES),
        strategies("recency_8_2", "s i p u r", "m", RECENCY_CTES),
    ]
)


def entries(family: str) -> str:
    return f"""coalesce(string_agg(category || ':' || {family}, ',' ORDER BY {family} DESC, category)
      FILTER (WHERE {family} > 0), '') AS {family}"""


add("behaviour_profile", "s p", f"""SELECT user_id, CAST(sum(cl) AS BIGINT) AS recent_clicks_count,
    CAST(sum(vw) AS BIGINT) AS recent_views_count, {entries('clicked')}, {entries('viewed')}, {entries('searched')},
    coalesce(min(favourites), '') AS favourites
    FROM c LEFT JOIN fv USING (user_id) GROUP BY user_id""", capped(7, 100),
    f"""f AS (SELECT *, {FAMILY} AS family, {POINTS} AS score FROM rc
      WHERE category IS NOT NULL AND ({FAMILY}) IS NOT NULL)""",
    f"""c AS (SELECT user_id, category, count(*) FILTER (WHERE family = 'clicked') AS cl,
      count(*) FILTER (WHERE {VIEW}) AS vw,
      coalesce(sum(score) FILTER (WHERE family = 'clicked'), 0) AS clicked,
      coalesce(sum(score) FILTER (WHERE family = 'viewed'), 0) AS viewed,
      coalesce(sum(score) FILTER (WHERE family = 'searched'), 0) AS searched FROM f GROUP BY user_id, category)""",
    f"""fv AS (SELECT user_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY k) AS favourites FROM (
      SELECT user_id, product_id, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, product_id) AS k
      FROM f WHERE {VIEW} GROUP BY user_id, product_id) WHERE k <= 5 GROUP BY user_id)""")

# ----------------------------------------------------------------- streaming

add("stream_timeline", "i", f"""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS bucket,
    count(*) FILTER (WHERE {CLICK}) AS clicks, count(*) FILTER (WHERE {VIEW}) AS views,
    count(*) FILTER (WHERE interaction_type = 'purchase') AS purchases FROM i GROUP BY 1""")
add("stream_product_counters", "e", """SELECT product_id,
    CASE WHEN event_type = 'product_view' THEN 'view' ELSE action END AS action, count(*) AS count FROM e
    WHERE event_type IN ('product_view', 'click') GROUP BY ALL""")
add("dedup_events", "e", """SELECT event_id, user_id, normalised_type, ts FROM (
    SELECT *, CASE WHEN before IS NULL OR ts > before + INTERVAL 86400 SECONDS THEN 1 ELSE 0 END AS fresh FROM (
      SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type, normalised_type, product_id, query, page, category
        ORDER BY ts, event_id) AS before FROM n)) WHERE fresh = 1""",
    """n AS (SELECT *, CASE WHEN event_type = 'search' THEN 'k' || k END AS query,
      CASE WHEN event_type = 'page_view' THEN '/product/' || k END AS page,
      CASE WHEN event_type = 'recommendation_click' THEN 'click' WHEN event_type = 'product_view' THEN 'view'
        ELSE 'other' END AS normalised_type FROM e)""")
add("keyed_latest", "i", f"""SELECT user_id, product_id, ts AS updated_at, interaction_type AS writer FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, interaction_id DESC, interaction_type DESC) AS k
    FROM i) WHERE k = 1 AND ts + INTERVAL 1 DAY > {NOW}""")
add("counters_live", "e", f"""SELECT product_id, action, count(*) AS count FROM al GROUP BY ALL
    UNION ALL SELECT product_id, 'total_interactions', count(*) FROM al GROUP BY product_id""",
    f"""ac AS (SELECT product_id, CASE WHEN event_type = 'product_view' THEN 'view' ELSE action END AS action, ts FROM e
      WHERE event_type IN ('product_view', 'click') AND ts <= {NOW})""",
    """lf AS (SELECT *, sum(fresh) OVER (PARTITION BY product_id ORDER BY ts) AS life FROM (
      SELECT *, CASE WHEN ts > lag(ts) OVER (PARTITION BY product_id ORDER BY ts) + INTERVAL 2 DAYS THEN 1 ELSE 0 END AS fresh
      FROM ac))""",
    f"""al AS (SELECT lf.* FROM lf JOIN (SELECT product_id, max(life) AS life, max(ts) AS last FROM lf GROUP BY product_id)
      USING (product_id, life) WHERE last + INTERVAL 2 DAYS >= {NOW})""")
add("session_activity", "b", "SELECT * FROM b")
add("gap_sessions", "e", """SELECT user_id, session_no, min(ts) AS session_start, max(ts) AS session_end,
    count(*) AS event_count FROM (
      SELECT *, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session_no FROM (
        SELECT *, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 60 MINUTES
          OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL THEN 1 ELSE 0 END AS fresh FROM e))
    GROUP BY user_id, session_no""")
add("engagement_events", "", f"""SELECT user_id, '/product/' || {K} AS page,
    CAST(max(CASE WHEN event_type = 'view' THEN floor(value * 100) END) AS DOUBLE) AS max_depth,
    CAST(sum(CASE WHEN event_type IN ('purchase', 'error') THEN floor(value * 100) END) AS DOUBLE) AS time_spent,
    avg(CASE WHEN event_type = 'click' THEN floor(value * 100) END) AS avg_load_time
    FROM events WHERE event_type <> 'signup' GROUP BY user_id, '/product/' || {K}""")
