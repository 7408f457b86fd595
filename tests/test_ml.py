import math
import random

import pytest
from clickloom.operators import aggregates, content, ml
from clickloom.plans import batch, hybrid
from clickloom.sources import keyed, sinks

from shop import AS_OF, rows


@pytest.fixture(scope="module")
def ratings(spark):
    rng = random.Random(11)
    data = [(u, p, float(1 + (u * p) % 5)) for u in range(30) for p in range(20) if rng.random() < 0.6]
    return spark.createDataFrame(data, "user_id bigint, product_id bigint, rating double")


def test_split_is_a_partition_and_stable(ratings):
    a = ml.split_ratings(ratings, 0.16, 0.2)
    b = ml.split_ratings(ratings.repartition(5), 0.16, 0.2)
    parts = [set(rows(x, "user_id", "product_id")) for x in (a.train, a.validation, a.test)]
    assert sum(map(len, parts)) == ratings.count() == len(set().union(*parts))
    assert parts[2] == set(rows(b.test, "user_id", "product_id"))
    assert 0.1 < len(parts[2]) / ratings.count() < 0.3


def test_text_ids_go_through_an_index_and_back(spark):
    data = [(f"u{k % 7}", f"p{k % 5}", float(1 + k % 5)) for k in range(70)]
    df = spark.createDataFrame(data, "user_id string, product_id string, rating double")
    indexed, labels = ml.index_ids(df)
    assert indexed.schema["user_index"].dataType.simpleString() == "int"
    assert {r.user_id for r in labels["user_id"].collect()} == {f"u{k}" for k in range(7)}
    model = ml.train_als(indexed, rank=2, iterations=2, blocks=2)
    recs = ml.recommend_for_all(model, labels, str(AS_OF), 3).collect()
    assert {r.user_id for r in recs} == {f"u{k}" for k in range(7)}
    for r in recs:
        assert [e["rank"] for e in r.recommendations] == [1, 2, 3]
        assert all(e.product_id.startswith("p") for e in r.recommendations)
        assert r.algorithm == "collaborative_filtering_als"


def test_tuning_keeps_the_lowest_error(ratings, tmp_path):
    indexed, _ = ml.index_ids(ratings)
    parts = ml.split_ratings(indexed, 0.2, 0.2)
    model, setting, rmse = ml.tune_als(parts.train, parts.validation, ((2, 1, 5.0), (4, 5, 0.05)), blocks=2)
    assert setting == (4, 5, 0.05) and rmse > 0
    sinks.save_model(model, str(tmp_path / "als"))
    again = sinks.load_als(str(tmp_path / "als"))
    assert again.rank == model.rank
    perf = ml.cf_performance(parts.test, model.transform(parts.test)).first()
    assert perf.model_type == "ALS_Collaborative_Filtering" and perf.rmse >= perf.mae > 0
    assert 0 < perf.user_coverage_percent <= 100


def test_metrics_by_hand(spark):
    df = spark.createDataFrame(
        [(1, 1, 3.0, 2.0), (1, 2, 1.0, 1.5), (2, 3, 4.0, None)],
        "user_id int, product_id int, rating double, prediction double",
    )
    m = ml.regression_metrics(df).first()
    assert math.isclose(m.rmse, math.sqrt((1 + 0.25) / 2)) and m.mae == 0.75 and m.total_predictions == 2
    assert tuple(ml.coverage(df, df).first()) == (50.0, 66.67, 2)


def features(spark):
    rng = random.Random(4)
    base = {c: "double" for c in ml.FEATURES}
    data = []
    for u in range(60):
        high = u % 2
        data.append((u, "AB"[high], *[100.0 * high + rng.random() for _ in ml.FEATURES]))
    data.append((99, None, *[None] * len(ml.FEATURES)))
    schema = "user_id int, most_viewed_category string, " + ", ".join(f"{c} {t}" for c, t in base.items())
    return spark.createDataFrame(data, schema)


def test_scaling_and_clusters(spark):
    scaled, _ = ml.assemble_scale(features(spark))
    vectors = [r.features.toArray() for r in scaled.collect()]
    assert all(abs(sum(v[k] for v in vectors)) < 1e-6 for k in range(len(ml.FEATURES)))
    model, scores = ml.kmeans_select_k(scaled, ks=(2, 3))
    assert set(scores) == {2, 3} and model.summary.k == 2 and scores[2] == max(scores.values())
    profile = ml.cluster_profile(model.transform(scaled)).collect()
    assert sorted(r.cluster_size for r in profile) == [30, 31]
    tops = sorted([tuple(e) for e in r.top_categories] for r in profile)
    assert tops == [[("A", 30)], [("B", 30)]]


def test_clustering_builds_the_features_once(spark):
    built = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            built.add(len(frame))
            yield frame

    made = features(spark)
    scaled, _ = ml.assemble_scale(made.mapInPandas(counted, made.schema))
    model, scores = ml.kmeans_select_k(scaled, ks=(2, 3, 4))
    assert model.transform(scaled).count() == 61 and built.value == 61
    assert scaled.select("user_id").distinct().count() == 61 and set(scores) == {2, 3, 4}


def test_silhouettes_equal_the_pairs(spark):
    rng = random.Random(3)
    points = {k: [(rng.randrange(k), [rng.random() * 3 for _ in ml.FEATURES]) for _ in range(25)] for k in (2, 4)}
    points[3] = [(0, [1.0] * len(ml.FEATURES)), (0, [1.0] * len(ml.FEATURES)), (2, [5.0] * len(ml.FEATURES))]
    points[1] = [(7, [float(k)] * len(ml.FEATURES)) for k in range(3)]
    rows = [(k, c, x) for k, members in points.items() for c, x in members]
    frame = spark.createDataFrame(rows, "k int, cluster int, features array<double>")
    got = {(r.k, r.cluster): r for r in ml.silhouettes(frame).collect()}
    for k, members in points.items():
        each = {}
        for i, (c, x) in enumerate(members):
            far = {}
            for j, (o, y) in enumerate(members):
                if i != j:
                    far.setdefault(o, []).append(sum((a - b) ** 2 for a, b in zip(x, y, strict=True)))
            means = {o: sum(d) / len(d) for o, d in far.items()}
            own, rest = means.pop(c, None), min(means.values(), default=None)
            known = own is not None and rest is not None and max(own, rest) > 0
            each.setdefault(c, []).append((rest - own) / max(own, rest) if known else 0.0)
        assert {c for n, c in got if n == k} == set(each)
        mean = sum(sum(v) for v in each.values()) / len(members)
        for c, v in each.items():
            assert got[k, c].users == len(v)
            assert abs(got[k, c].silhouette - sum(v) / len(v)) < 1e-9
            assert abs(got[k, c].mean_silhouette - mean) < 1e-9
    assert ml.silhouettes(frame.limit(0)).collect() == []


def test_silhouettes_equal_the_evaluator(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator

    scaled, _ = ml.assemble_scale(features(spark))
    model, scores = ml.kmeans_select_k(scaled, ks=(2, 3))
    wanted = ClusteringEvaluator().evaluate(model.transform(scaled))
    assert abs(scores[model.summary.k] - wanted) < 1e-9


def test_cluster_rules_take_the_first_match(spark):
    profile = spark.createDataFrame(
        [
            (0, 1, 21.0, 51.0, 11.0, 1.0),
            (1, 2, 5.0, 30.0, 11.0, 200000.0),
            (2, 3, 5.0, 5.0, 5.0, 100001.0),
            (3, 4, 11.0, 5.0, 5.0, None),
            (4, 5, 5.0, 5.0, 5.0, None),
        ],
        "prediction int, cluster_size long, avg_interactions double, avg_engagement double, "
        "avg_unique_products double, avg_price_preference double",
    )
    out = {r.cluster: r for r in ml.label_clusters(profile).collect()}
    assert [out[f"cluster_{k}"].type for k in range(5)] == list(ml.CLUSTER_TYPES)
    assert out["cluster_3"].avg_price_preference == 0.0
    assert out["cluster_0"].marketing_strategy.startswith("VIP")


def test_hybrid_blend_by_hand(spark):
    scores = spark.createDataFrame(
        [(1, 1, "cf", 4.0), (1, 2, "cf", 2.0), (1, 2, "popularity", 10.0), (1, 3, "content", 1.0), (1, 9, "other", 9.0)],
        "user_id int, product_id int, source string, score double",
    )
    got = rows(ml.hybrid_blend(scores).orderBy("rank"), "product_id", "score", "rank")
    assert got == [(1, 0.4, 1), (2, 0.4, 2), (3, 0.3, 3)]


def test_content_similarity_against_all_pairs(shop):
    rng = random.Random(8)
    words = ["red", "blue", "small", "ring", "bolt", "Gạo", "tẻ", "x"]
    data = [(k, rng.choice("AB"), 1.0, " ".join(rng.choices(words, k=rng.choice([1, 2, 3])))) for k in range(80)]
    got = {}
    for r in content.content_similarity(shop.products(data), 4).orderBy("rank").collect():
        got.setdefault(r.product_id, []).append((r.similar_id, r.similarity))
    bags = {k: [w.lower() for w in name.split()] for k, _, _, name in data}
    df = {w: sum(w in b for b in bags.values()) for w in {x for b in bags.values() for x in b}}
    vectors = {}
    for k, bag in bags.items():
        v = {w: bag.count(w) * (math.log((len(data) + 1) / (df[w] + 1)) + 1) for w in bag}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vectors[k] = {w: x / norm for w, x in v.items()}
    category = {k: c for k, c, _, _ in data}
    for k in vectors:
        near = []
        for j in vectors:
            if j != k and category[j] == category[k]:
                s = round(sum(x * vectors[j].get(w, 0.0) for w, x in vectors[k].items()), 6)
                if s > 0:
                    near.append((-s, j))
        assert got.get(k, []) == [(j, -s) for s, j in sorted(near)[:4]]


def test_one_word_in_every_text(shop):
    products = shop.products([(k, "A", 1.0, f"gold w{k} x{k % 150}") for k in range(300)])
    got = content.content_similarity(products, 3).collect()
    assert len(got) == 900
    first = {r.product_id: r.similar_id for r in got if r["rank"] == 1}
    assert all(first[k] == (k + 150) % 300 for k in range(300))


def test_equal_contents_behind_the_heads_are_not_read(spark, shop, monkeypatch):
    """One word in all 3,000 texts at the same weight: ties go to small ids, which the heads hold."""
    seen = []
    further = content._further_pairs
    monkeypatch.setattr(content, "_further_pairs", lambda *a: seen.append(further(*a)) or seen[-1])
    products = shop.products([(k, "A", 1.0, f"gold w{k}") for k in range(3000)])
    got = content.content_similarity(products, 3)
    assert seen[0].count() == 0
    for r in got.where("product_id in (0, 2, 2999)").collect():
        assert r.similar_id == [j for j in range(4) if j != r.product_id][r["rank"] - 1]


def test_levels_are_read_down_to_the_bound(spark, shop, monkeypatch):
    rng = random.Random(21)
    words = [f"w{k}" for k in range(40)]
    data = [(k, "A", 1.0, " ".join(["all"] * rng.randint(1, 3) + rng.choices(words, k=rng.randint(1, 6)))) for k in range(400)]
    counts = []
    further = content._further_pairs
    monkeypatch.setattr(content, "_further_pairs", lambda *a: counts.append(further(*a).count()) or further(*a))
    lists = {}
    for r in content.content_similarity(shop.products(data), 4).orderBy("rank").collect():
        lists.setdefault(r.product_id, []).append((r.similar_id, r.similarity))
    bags = [t.split() for _, _, _, t in data]
    df = {w: sum(w in b for b in bags) for w in {x for b in bags for x in b}}
    vectors = []
    for bag in bags:
        v = {w: bag.count(w) * (math.log(401 / (df[w] + 1)) + 1) for w in bag}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({w: x / norm for w, x in v.items()})
    for k, own in enumerate(vectors):
        near = [(-round(sum(x * v.get(w, 0.0) for w, x in own.items()), 6), j) for j, v in enumerate(vectors) if j != k]
        assert lists[k] == [(j, -s) for s, j in sorted(near)[:4]]
    assert counts[0] < 0.5 * 400 * 399


def test_model_ids_keep_integers(spark):
    data = [(5, -7, 1.0), (2**31 - 1, 9, 2.0), (None, 9, 1.0), (5, None, 1.0)]
    rated, labels = ml.model_ids(spark.createDataFrame(data, "user_id bigint, product_id bigint, rating double"))
    assert sorted(rows(rated, "user_id", "user_index", "product_index")) == [(5, 5, -7), (2**31 - 1, 2**31 - 1, 9)]
    assert sorted(rows(labels["product_id"], "product_index", "product_id")) == [(-7, -7), (9, 9)]
    wide, _ = ml.model_ids(spark.createDataFrame([(2**40, 1, 1.0), (3, 1, 1.0)], "user_id bigint, product_id bigint, rating double"))
    assert sorted(rows(wide, "user_id", "user_index")) == [(3, 0), (2**40, 1)]
    named, _ = ml.model_ids(spark.createDataFrame([("b", 1, 1.0), ("a", 1, 1.0)], "user_id string, product_id bigint, rating double"))
    assert sorted(rows(named, "user_id", "user_index")) == [("a", 0), ("b", 1)]
    nothing, _ = ml.model_ids(spark.createDataFrame([], "user_id bigint, product_id bigint, rating double"))
    assert nothing.count() == 0


def test_dense_index_is_the_rank_of_an_id(spark):
    ids = [5, -3, 2**40, 7, 5, None, 0]
    got = dict(rows(ml.dense_index(spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(4))))
    assert got == {-3: 0, 0: 1, 5: 2, 7: 3, 2**40: 4}
    assert ml.dense_index(spark.createDataFrame([], "id string")).collect() == []


def test_a_rerun_for_a_past_time_gives_the_same(spark, shop, tmp_path):
    rng = random.Random(3)
    old = [(rng.randrange(9), rng.randrange(8), rng.choice(["view", "click"]), rng.randrange(1, 86400)) for _ in range(200)]
    new = [(1, 50, "purchase", -60), (77, 1, "purchase", -5)]
    results = []
    for k, data in enumerate((old, old + new)):
        root = str(tmp_path / str(k))
        batch.run_collaborative(shop.interactions(data), root, AS_OF, n=3, grid=((2, 2, 0.1),))
        lists = spark.read.json(f"{root}/collaborative_filtering").collect()
        results.append(sorted((r.user_id, [e.product_id for e in r.recommendations]) for r in lists))
    assert results[0] == results[1]


def test_hybrid_lists_use_all_sources(spark, shop):
    rng = random.Random(2)
    products = shop.products([(k, "AB"[k % 2], 5.0, f"w{k % 4} v{k % 3}") for k in range(24)])
    seen = shop.interactions([(u, rng.randrange(20), rng.choice(["view", "click"]), k) for u in range(6) for k in range(9)])
    similar = content.content_similarity(products)
    scores = hybrid.sources(seen, products, similar)
    assert {r.source for r in scores.select("source").distinct().collect()} == set(ml.HYBRID_WEIGHTS) - {"cf"}
    lists = hybrid.recommend_hybrid(seen, products, n=5).collect()
    assert len(lists) == 30 and all(0 < r.score <= 1 for r in lists)


def test_hybrid_lists_are_those_of_all_pairs(spark, shop, monkeypatch):
    rng = random.Random(4)
    products = shop.products([(k, "AB"[k % 2], 5.0, f"w{k % 7} v{k % 5}") for k in range(60)])
    data = [(u, rng.randrange(59), rng.choice(["view", "click", "purchase"]), k) for u in range(12) for k in range(16)]
    data += [(20 + k, 59, "view", k) for k in range(40)]  # a bestseller of users of its own
    seen = shop.interactions(data)
    fitted = []
    train = ml.train_als

    def once(ratings, **kwargs):
        if not fitted:
            fitted.append(train(ratings, **kwargs))
        return fitted[0]

    monkeypatch.setattr(ml, "train_als", once)
    monkeypatch.setattr(hybrid, "BLOCK", 7)
    monkeypatch.setattr(hybrid, "TOGETHER", 3)
    similar = content.content_similarity(products).persist()
    got = {}
    for r in hybrid.recommend_hybrid(seen, products, similar=similar).orderBy("rank").collect():
        got.setdefault(r.user_id, []).append((r.product_id, r.score))

    _, labels = ml.model_ids(aggregates.implicit_ratings(seen))
    parts = {name: {} for name in ml.HYBRID_WEIGHTS}
    users, goods = (
        {r[1]: r.features for r in factors.join(labels[c].withColumnRenamed(i, "id"), "id").select("features", c).collect()}
        for factors, c, i in (
            (fitted[0].userFactors, "user_id", "user_index"), (fitted[0].itemFactors, "product_id", "product_index")
        )
    )
    everyone = {x[0] for x in data}
    near = {}
    for r in similar.collect():
        near.setdefault(r.product_id, []).append((r.similar_id, r.similarity))
    for u in everyone:
        for p in range(60):
            if u in users and p in goods:
                parts["cf"][u, p] = sum(a * b for a, b in zip(users[u], goods[p]))
            parts["popularity"][u, p] = sum(x[1] == p for x in data)
    for r in hybrid.behaviour_scores(seen, products).collect():
        parts["behavior"][r.user_id, r.product_id] = r.score
        for p, s in near.get(r.product_id, []):
            parts["content"][r.user_id, p] = parts["content"].get((r.user_id, p), 0.0) + r.score * s
    assert set(got) == everyone
    for u in everyone:
        whole = {}
        for name, weight in ml.HYBRID_WEIGHTS.items():
            own = {p: v for (k, p), v in parts[name].items() if k == u and v > 0}
            for p, v in own.items():
                whole[p] = whole.get(p, 0.0) + weight * v / max(own.values())
        best = sorted(whole.values(), reverse=True)[:10]
        assert [s for _, s in got[u]] == pytest.approx(best, abs=1e-5)
        assert [whole[p] for p, _ in got[u]] == pytest.approx(best, abs=1e-5)


@pytest.mark.parametrize("block,scores", [(4, 10), (16, 10**6)])
def test_best_products_equal_all_pairs(spark, monkeypatch, block, scores):
    rng = random.Random(9)
    monkeypatch.setattr(hybrid, "BLOCK", block)
    monkeypatch.setattr(hybrid, "TOGETHER", 8)
    monkeypatch.setattr(hybrid, "SCORES", scores)
    centres = [[rng.gauss(0, 1) for _ in range(4)] for _ in range(6)]
    vector = lambda: [x + rng.gauss(0, 0.1) for x in rng.choice(centres)]
    users = [(k, vector(), 0.3) for k in range(50)]
    goods = [(k, vector(), rng.random()) for k in range(120)] + [(200 + k, [1.0, 0.0, 0.0, 0.0], 0.5) for k in range(20)]
    wanted = spark.createDataFrame(users, "user_id bigint, features array<double>, weight double")
    blocks = hybrid.product_blocks(spark.createDataFrame(goods, "product_id bigint, features array<double>, share double"))
    read = []
    scored = hybrid._scored
    monkeypatch.setattr(hybrid, "_scored", lambda w, g, n, p: read.append(w.join(g, "block").count()) or scored(w, g, n, p))
    got = {}
    for r in hybrid.best_products(wanted, blocks, 5).orderBy("rank").collect():
        got.setdefault(r.user_id, []).append((r.product_id, r.score))
    for k, own, weight in users:
        full = sorted((-round(sum(a * b for a, b in zip(own, v, strict=True)) + weight * s, 9), p) for p, v, s in goods)
        assert [p for p, _ in got[k]] == [p for _, p in full[:5]]
    assert sum(read) < 0.75 * len(users) * len(goods)


def test_best_products_of_nothing(spark):
    users = spark.createDataFrame([(1, [1.0], 0.2)], "user_id bigint, features array<double>, weight double")
    goods = spark.createDataFrame([], "product_id bigint, features array<double>, share double")
    assert hybrid.best_products(users, hybrid.product_blocks(goods), 3).collect() == []


def test_batch_jobs_are_repeatable(spark, shop, tmp_path):
    rng = random.Random(6)
    data = shop.interactions(
        [(rng.randrange(12), rng.randrange(10), rng.choice(["view", "click", "purchase"]), rng.randrange(86400 * 5))
         for _ in range(400)]
    )
    products = shop.products([(k, "ABC"[k % 3], 50.0 + k) for k in range(10)])
    root = str(tmp_path / "batch")
    for _ in range(2):
        batch.run_behaviour_batch(data, products, root, AS_OF, n=5, als_blocks=2)
    segments = keyed.read_keyed(spark, f"{root}/user_segment", ["user_id"], AS_OF)
    assert segments.count() == 12
    assert keyed.read_keyed(spark, f"{root}/recommendations", ["user_id"], AS_OF).count() == 12
    assert keyed.read_keyed(spark, f"{root}/trending_products", ["product_id"], AS_OF).count() == 10
    insights = batch.run_segmentation(data, products, root, AS_OF)
    assert insights.agg({"size": "sum"}).first()[0] == 12
    perf = batch.run_collaborative(data, root, AS_OF, n=3, grid=((2, 2, 0.1),), als_blocks=2).first()
    assert perf.model_type == "ALS_Collaborative_Filtering"
    assert spark.read.json(f"{root}/collaborative_filtering").count() == 12
