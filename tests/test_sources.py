from datetime import timedelta

from clickloom.sources import events as event_source
from clickloom.sources import keyed, session, sinks, tables
from pyspark.sql import functions as F

from shop import AS_OF, rows


def test_parse_and_reject(spark):
    lines = [
        '{"event_id":"e1","user_id":1,"event_type":"product_view","data":{"product_id":5,"category":"A"},"timestamp":"2024-05-01T10:00:00","session_id":"s"}',
        '{"user_id":2,"event_type":"category_view","category":"Rau củ quả","timestamp":"2024-05-01T10:00:01"}',
        '{"user_id":"x","event_type":"click","data":{},"timestamp":"soon","extra":1}',
        '{"user_id":3,"data":{}}',
        "not json",
        "",
    ]
    raw = spark.createDataFrame([(x,) for x in lines], "value string").select(F.col("value").cast("binary").alias("value"))
    parsed = event_source.parse_events(raw)
    got = parsed.collect()
    assert [r.event_type for r in got] == ["product_view", "category_view", "click"]
    assert got[0].event_id == "e1" and got[0].data["product_id"] == "5"
    assert got[1].data == {"category": "Rau củ quả"} and len(got[1].event_id) == 64
    assert got[2].user_id is None and got[2].ts is None
    assert event_source.rejected_events(raw).count() == 3
    whole = event_source.parse_events(raw, rejects=True)
    assert sorted(r.raw for r in whole.where("event_type is null").collect()) == ["", "not json", '{"user_id":3,"data":{}}']
    odd = spark.createDataFrame([('{"event_type":"x","data":"hello"}',), ('{"event_type":"x","data":[1]}',)], "value string")
    parsed = event_source.parse_events(odd.select(F.col("value").cast("binary").alias("value")))
    assert [r.data for r in parsed.collect()] == [{"info": "hello"}, {"info": "[1]"}]


KIND = "user_id int, v string"


def keyed_table(spark, path):
    def put(data, at, version, writer="batch", ttl=100):
        keyed.publish_keyed(spark.createDataFrame(data, KIND), path, ["user_id"], ttl, at, version, writer)

    def get(at, **options):
        return sorted(rows(keyed.read_keyed(spark, path, ["user_id"], at, **options), "user_id", "v"))

    return put, get


def later(seconds):
    return AS_OF + timedelta(seconds=seconds)


def test_keyed_table(spark, tmp_path):
    path = str(tmp_path / "k")
    put, get = keyed_table(spark, path)
    empty = "user_id int, v string, updated_at timestamp_ntz, expires_at timestamp_ntz"
    assert keyed.read_keyed(spark, path, ["user_id"], AS_OF, empty).count() == 0
    put([(1, "a"), (2, "b")], AS_OF, 1)
    put([(1, "c"), (3, "d")], later(50), 2)
    assert get(later(60)) == [(1, "c"), (2, "b"), (3, "d")]
    # user 2 expires, user 1 was written again and lives on
    assert get(later(100)) == [(1, "c"), (3, "d")]
    put([(1, "c"), (3, "e")], later(50), 2)
    assert get(later(60)) == [(1, "c"), (2, "b"), (3, "e")]
    keyed.compact(spark, path, ["user_id"], later(60))
    assert get(later(60)) == [(1, "c"), (2, "b"), (3, "e")]
    for v in range(3, 8):
        put([(4, f"v{v}")], later(60 + v), v)
    assert get(later(70))[-1] == (4, "v7")
    for _ in range(2):
        keyed.compact(spark, path, ["user_id"], later(110))
        assert get(later(110)) == [(1, "c"), (3, "e"), (4, "v7")]


def test_writers_share_a_table_by_time(spark, tmp_path):
    put, get = keyed_table(spark, str(tmp_path / "k"))
    put([(1, "batch"), (2, "batch")], AS_OF, 1_714_564_800, "batch")
    put([(1, "stream")], later(10), 0, "stream-a")  # a small number, but later
    put([(2, "early")], later(-10), 1, "stream-a")
    assert get(later(20)) == [(1, "stream"), (2, "batch")]


def test_small_versions_are_read_after_compaction(spark, tmp_path):
    path = str(tmp_path / "k")
    put, get = keyed_table(spark, path)
    for k in range(3):
        put([(1, f"b{k}")], later(k), 1000 + k, "batch")
    for _ in range(2):
        keyed.compact(spark, path, ["user_id"], later(5))
    put([(1, "late")], later(6), 0, "stream-a")
    assert get(later(7)) == [(1, "late")]
    # a folded version that is written again counts again
    put([(2, "again")], later(1), 1001, "batch")
    assert get(later(7)) == [(1, "late"), (2, "again")]
    keyed.compact(spark, path, ["user_id"], later(7))
    assert get(later(7)) == [(1, "late"), (2, "again")]
    # only what a running reader may hold is left: the folded versions and each writer's newest
    kept = sorted(p.name for p in (tmp_path / "k" / "data").glob("_w=batch/_v=*"))
    assert kept == ["_v=1001", "_v=1002"]


def test_a_compaction_that_dies_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "k")
    put, get = keyed_table(spark, path)
    put([(1, "a"), (2, "a")], AS_OF, 1)
    put([(1, "b")], later(1), 2)

    def dies(rows):
        raise RuntimeError

    try:
        keyed.compact_versions(spark, path, ["user_id"], dies)
    except RuntimeError:
        pass
    assert get(later(2)) == [(1, "b"), (2, "a")]
    keyed.compact(spark, path, ["user_id"], later(2))
    assert get(later(2)) == [(1, "b"), (2, "a")]


def test_a_replayed_batch_does_not_see_itself(spark, tmp_path):
    put, get = keyed_table(spark, str(tmp_path / "k"))
    put([(1, "first")], AS_OF, 0, "s")
    put([(1, "own")], later(1), 1, "s")
    assert get(later(2), before=("s", 1)) == [(1, "first")]
    assert get(later(2), before=("other", 0)) == [(1, "own")]


def test_only_the_buckets_of_the_keys_are_opened(spark, tmp_path):
    path = str(tmp_path / "k")
    put, get = keyed_table(spark, path)
    put([(k, "x") for k in range(200)], AS_OF, 1)
    only = spark.createDataFrame([(7,), (8,), (999,)], "user_id bigint")
    assert get(later(1), only=only) == [(7, "x"), (8, "x")]
    one = spark.createDataFrame([(7,)], "user_id bigint")
    plan = keyed.read_keyed(spark, path, ["user_id"], later(1), only=one)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "(_bucket" in plan.split("PartitionFilters")[1][:80]


def test_the_time_of_a_row_gives_its_life(spark, tmp_path):
    path = str(tmp_path / "k")
    data = [(1, AS_OF), (2, later(50))]
    df = spark.createDataFrame(data, "user_id int, seen timestamp_ntz")
    keyed.publish_keyed(df, path, ["user_id"], 100, F.col("seen"), 0, "counts")
    assert rows(keyed.read_keyed(spark, path, ["user_id"], later(120)), "user_id") == [(2,)]


def test_writer_belongs_to_the_checkpoint(spark, tmp_path):
    one, two = (keyed.writer_of(spark, str(tmp_path / c), "s") for c in "ab")
    assert one != two and one == keyed.writer_of(spark, str(tmp_path / "a"), "s")


def test_partitioned_write_prunes(spark, shop, tmp_path):
    path = str(tmp_path / "p")
    products = shop.products([(k, "AB"[k % 2]) for k in range(40)])
    sinks.write_partitioned(products, path)
    sinks.write_partitioned(products, path)
    one = tables.read_parquet_table(spark, path, category="A")
    assert one.count() == 20 and spark.read.parquet(path).count() == 40
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category" in plan


def test_snapshot_json_and_import(spark, shop, tmp_path):
    products = shop.products([(k, "A") for k in range(5)])
    sinks.write_snapshot(products, str(tmp_path / "s"))
    sinks.write_json(products.select("product_id", "category"), str(tmp_path / "j"))
    back = tables.load_json_results(spark, str(tmp_path / "j"), "product_id bigint, category string")
    assert sorted(rows(back)) == [(k, "A") for k in range(5)]
    assert tables.import_relational(products, str(tmp_path / "i")) == 5
    facts = tables.enriched_interactions(shop.interactions([(1, 2, "click", 0), (1, None, "search", 0)]), products)
    sinks.write_partitioned(facts, str(tmp_path / "f"))
    assert sorted(rows(spark.read.parquet(str(tmp_path / "f")), "interaction_score", "hour_of_day")) == [(1, 12), (3, 12)]


def test_append_of_a_batch_replaces_its_replay(spark, shop, tmp_path):
    path = str(tmp_path / "raw")
    sinks.append_interactions(shop.interactions([(1, 1, "view", 0), (1, 1, "view", 86400)]), path, 0)
    sinks.append_interactions(shop.interactions([(2, 1, "view", 0)]), path, 1)
    sinks.append_interactions(shop.interactions([(2, 1, "view", 0)]), path, 1)
    assert spark.read.parquet(path).count() == 3
    assert spark.read.parquet(path).filter("event_date = '2024-05-01'").count() == 2
    sinks.append_interactions(shop.interactions([(3, 1, "view", 0)]), path, 1, "stream-b")
    assert spark.read.parquet(path).count() == 4


def test_messages_carry_key_and_json(shop):
    msg = sinks.as_messages(shop.events([(7, "click", {"a": "b"}, 0)])).first()
    assert msg.key == "7" and '"data":{"a":"b"}' in msg.value


def test_checkpoint_folder(spark, tmp_path):
    assert session.ensure_checkpoint_dir(spark, str(tmp_path / "c"))
    assert session.ensure_checkpoint_dir(spark)
