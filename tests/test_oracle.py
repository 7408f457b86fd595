"""Every query with an oracle text against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from clickloom.registry.oracle import ORACLE
from clickloom.registry.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "" if math.isnan(value) else repr(value)
    return "" if value is None else str(value)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted(tuple(plain(r[k]) for k in order) for r in cursor.fetchall())
    assert ours == theirs


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"train_als", "recommend_for_all", "kmeans_clusters"}


def test_model_queries(spark):
    pairs = QUERIES["train_als"](spark, SF).collect()
    assert pairs and all(r.prediction is not None for r in pairs)
    recs = QUERIES["recommend_for_all"](spark, SF).collect()
    per_user = {}
    for r in sorted(recs, key=lambda r: (r.user_id, r["rank"])):
        per_user.setdefault(r.user_id, []).append(r)
    for lst in per_user.values():
        assert [r["rank"] for r in lst] == list(range(1, len(lst) + 1)) and len(lst) <= 10
        assert len({r.product_id for r in lst}) == len(lst)
        scores = [r.predicted_rating for r in lst]
        assert scores == sorted(scores, reverse=True)
    clusters = {r.prediction for r in QUERIES["kmeans_clusters"](spark, SF).collect()}
    assert 2 <= len(clusters) <= 7
