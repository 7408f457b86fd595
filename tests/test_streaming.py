"""Streams over a file source, run to the end of the available data."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from clickloom.operators import aggregates, dashboards, projections, windows
from clickloom.plans.refresh import refresh_recommendations
from clickloom.sources import events as event_source
from clickloom.sources import keyed
from clickloom.streaming import counters, jobs, refresh_state, session_state, stateful
from pyspark.sql import functions as F

from shop import AS_OF, rows


def write_lines(folder, batches):
    """One file per batch; the file times give the order of the batches."""
    folder.mkdir(parents=True, exist_ok=True)
    for k, lines in enumerate(batches):
        path = folder / f"{k:03d}.json"
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))


def line(user, kind, age, session=None, event_id=None, **data):
    record = {
        "user_id": user, "event_type": kind, "data": data,
        "timestamp": (AS_OF - timedelta(seconds=age)).isoformat(), "session_id": session,
    }
    if event_id:
        record["event_id"] = event_id
    return json.dumps(record, ensure_ascii=False)


def stream(spark, folder):
    return event_source.parse_events(event_source.file_source(spark, str(folder), 1))


def stream_with_rejects(spark, folder):
    return event_source.parse_events(event_source.file_source(spark, str(folder), 1), rejects=True)


def static(spark, folder):
    raw = spark.read.text(str(folder)).select(F.col("value").cast("binary").alias("value"))
    return event_source.parse_events(raw)


def drain(df, mode, tmp_path, name):
    out = str(tmp_path / name)
    checkpoint = str(tmp_path / f"{name}_cp")
    if mode == "update":
        raise ValueError("update streams are published by key")
    q = (
        df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(out)
    )
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)


def shop_batches(seed, batches=3, n=40):
    rng = random.Random(seed)
    out = []
    for b in range(batches):
        lines = []
        for k in range(n):
            kind = rng.choice(["product_view", "click", "recommendation_click", "search", "page_view"])
            data = {
                "product_id": rng.randrange(8), "category": rng.choice("AB"),
                "price": rng.choice([5, 2_000_000, "free"]), "action": rng.choice(["add_to_cart", "buy"]),
            }
            if kind == "search":
                data = {"query": f"q{k}"}
            elif kind == "page_view":
                data = {"page": f"/p/{k}"}
            lines.append(line(rng.randrange(4), kind, 5000 - b * 1000 - k, f"s{k % 5}", f"{b}-{k}", **data))
        lines.append("broken")
        out.append(lines)
    return out


def test_router_stores_everything_once(spark, tmp_path):
    write_lines(tmp_path / "in", shop_batches(1))
    root, forwarded = str(tmp_path / "root"), []
    q = jobs.event_router(
        stream_with_rejects(spark, tmp_path / "in"), root, str(tmp_path / "cp"),
        lambda df, i: forwarded.append((i, df.count())), available_now=True,
    )
    q.awaitTermination()
    events = static(spark, tmp_path / "in").persist()
    assert spark.read.parquet(f"{root}/raw_events").count() == events.count() == 120
    assert [r.raw for r in spark.read.parquet(f"{root}/rejected_events").collect()] == ["broken"] * 3
    assert sorted(forwarded) == [(0, 40), (1, 40), (2, 40)]
    want = projections.to_interaction(events)
    columns = ("user_id", "product_id", "interaction_type")
    stored = spark.read.parquet(f"{root}/interactions")
    assert sorted(rows(stored, *columns)) == sorted(rows(want, *columns))
    writer = {r.writer for r in stored.select("writer").distinct().collect()}.pop()

    def counts():
        return dict(rows(spark.read.parquet(f"{root}/sink_counts").groupBy("sink").sum("rows")))

    assert counts() == {"input": 123, "raw_events": 120, "rejected_events": 3, "interactions": want.count()}

    def check():
        counted = stateful.stream_product_counters(events)
        got = jobs.counters.read_counters(spark, root, "product_counters", AS_OF)
        fields = ("product_id", "action", "count")
        assert sorted(rows(got.where("action <> 'total_interactions'"), *fields)) == sorted(rows(counted, *fields))
        total = counted.groupBy("product_id").sum("count")
        assert sorted(rows(got.where("action = 'total_interactions'"), "product_id", "count")) == sorted(rows(total))
        profile = aggregates.user_profile_counters(events)
        got = jobs.counters.read_counters(spark, root, "profile_counters", AS_OF)
        assert sorted(rows(got, "user_id", "kind", "value", "count")) == sorted(rows(profile))
        got = jobs.counters.read_counters(spark, root, "recommendation_clicks", AS_OF)
        assert sorted(rows(got, "product_id", "count")) == sorted(rows(aggregates.recommendation_clicks(events)))
        for kind in windows.HISTORIES:
            got = jobs.counters.read_history(spark, root, kind, AS_OF)
            whole = windows.bounded_history(events, kind)
            assert sorted(rows(got, "user_id", "rank", "event_id")) == sorted(rows(whole, "user_id", "rank", "event_id"))

    check()
    # a replayed batch replaces itself
    first = event_source.parse_events(
        spark.read.text(str(tmp_path / "in" / "000.json")).select(F.col("value").cast("binary").alias("value")), True
    )
    jobs.route_batch(first, 0, root, writer=writer)
    assert spark.read.parquet(f"{root}/raw_events").count() == 120
    assert spark.read.parquet(f"{root}/rejected_events").count() == 3
    assert counts()["input"] == 123
    check()
    for _ in range(2):
        jobs.fold_stores(spark, root, AS_OF)
        check()
    # a stream that starts anew under another checkpoint adds, whatever its batch ids
    jobs.route_batch(first, 0, root, writer="router-other")
    assert spark.read.parquet(f"{root}/raw_events").count() == 160


def test_counters_live_as_long_as_they_are_written(shop):
    day = 86_400
    view = lambda product, age: (1, "product_view", {"product_id": str(product)}, age)
    events = shop.events(
        [view(1, 60 * day), view(1, 40 * day), view(1, 12 * day),  # never a pause of thirty days
         view(2, 80 * day), view(2, 40 * day), view(2, 20 * day),  # anew after a pause
         view(3, 31 * day),  # gone
         (1, "click", {"product_id": "2", "action": "buy"}, day)]
    )
    got = counters.live_counters(counters.increments(events, "product_counters"), counters.COUNTERS["product_counters"], AS_OF)
    assert sorted(rows(got, "product_id", "action", "count")) == [
        (1, "total_interactions", 3), (1, "view", 3), (2, "buy", 1), (2, "total_interactions", 3), (2, "view", 2),
    ]


def test_history_lives_as_a_whole(shop):
    day = 86_400
    view = lambda user, age: (user, "product_view", {"product_id": "5"}, age)
    events = shop.events([view(1, 0), view(1, 6 * day), view(1, 12 * day), view(1, 30 * day), view(2, 8 * day)])
    got = counters.live_history(windows.bounded_history(events, "recent_views").drop("rank"), "recent_views", AS_OF)
    assert sorted(rows(got, "user_id", "event_id", "rank")) == [(1, "0", 1), (1, "1", 2), (1, "2", 3)]


def test_refresh_stream_equals_folded_batches(spark, tmp_path):
    batches = shop_batches(2)
    write_lines(tmp_path / "in", [*batches, [line(9, "page_view", 1, page="/")]])
    trending = spark.createDataFrame([(k, k) for k in range(1, 8)], "product_id bigint, rank int")
    shelf = spark.createDataFrame(
        [(c, 10 * (1 + "AB".index(c)) + k, k) for c in "AB" for k in range(1, 6)],
        "category string, product_id bigint, rank int",
    )
    store = str(tmp_path / "store")
    q = jobs.stream_refresh(
        stream(spark, tmp_path / "in"), store, lambda: (trending, shelf), str(tmp_path / "cp"), available_now=True
    )
    q.awaitTermination()
    got = dict(rows(keyed.read_keyed(spark, store, ["user_id"], AS_OF), "user_id", "product_ids"))
    have = {}
    for k in range(3):
        now = static(spark, tmp_path / "in" / f"{k:03d}.json")
        old = spark.createDataFrame(list(have.items()), "user_id bigint, product_ids array<bigint>")
        have |= dict(rows(refresh_recommendations(now, old, trending, shelf)))
    assert got == have and 9 not in got
    assert all(len(v) <= 15 and len(set(v)) == len(v) for v in got.values())


def as_interactions(events):
    kind = F.when(F.col("event_type") == "product_view", "view").otherwise("click")
    return events.withColumn("interaction_type", kind).select("interaction_type", "ts")


SHELF = [(c, 10 * (1 + "AB".index(c)) + k, k) for c in "AB" for k in range(1, 6)]


def test_state_lists_equal_folded_batches(spark, tmp_path):
    batches = shop_batches(12)
    write_lines(tmp_path / "in", [*batches, [line(9, "page_view", 1, page="/")]])
    trending = spark.createDataFrame([(k, k) for k in range(1, 8)], "product_id bigint, rank int")
    shelf = spark.createDataFrame(SHELF, "category string, product_id bigint, rank int")
    lists = refresh_state.stream_lists(stream(spark, tmp_path / "in"), trending, shelf)
    jobs.store_lists(lists, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out"))
    got = dict(rows(jobs.newest_lists(stored), "user_id", "product_ids"))
    have = {}
    for k in range(3):
        now = static(spark, tmp_path / "in" / f"{k:03d}.json")
        old = spark.createDataFrame(list(have.items()), "user_id bigint, product_ids array<bigint>")
        have |= dict(rows(refresh_recommendations(now, old, trending, shelf)))
    assert got == have and 9 not in got


def test_state_lists_end_after_their_life(spark, tmp_path):
    day = 86_400
    view = lambda user, age, product: line(user, "product_view", age, product_id=product, category="A")
    steps = [
        [view(1, 10 * day, 11), view(2, 10 * day, 12)],
        [view(1, 8 * day, 12)],  # two days later: the list goes on
        [view(2, 5 * day, 11), view(3, 5 * day, 11)],  # five days later: a new list
        [view(1, 2 * day, 13), line(4, "click", 2 * day)],
    ]
    trending = spark.createDataFrame([], "product_id bigint, rank int")
    shelf = spark.createDataFrame(SHELF, "category string, product_id bigint, rank int")
    out = str(tmp_path / "out")
    write_lines(tmp_path / "in", steps)
    lists = refresh_state.stream_lists(stream(spark, tmp_path / "in"), trending, shelf)
    jobs.store_lists(lists, out, str(tmp_path / "cp"), available_now=True).awaitTermination()
    seen = {}
    for user, products in rows(spark.read.parquet(out).orderBy("batch_id"), "user_id", "product_ids"):
        seen.setdefault(user, []).append(products)
    assert seen == {1: [[12, 13], [11, 13, 12], [11, 12]], 2: [[11, 13], [12, 13]], 3: [[12, 13]], 4: [[]]}


def test_many_lists_share_few_groups(spark, tmp_path):
    rng, day = random.Random(5), 86_400
    steps = []
    for back in (9, 7, 6, 2, 1):  # lists end between the third and the fourth
        users = rng.sample(range(100), 70)
        steps.append([line(u, "product_view", back * day + rng.randrange(100), product_id=rng.randrange(30), category=rng.choice("AB")) for u in users * 2])
    write_lines(tmp_path / "in", steps)
    trending = spark.createDataFrame([(k, k) for k in range(1, 4)], "product_id bigint, rank int")
    shelf = spark.createDataFrame(SHELF, "category string, product_id bigint, rank int")
    lists = refresh_state.stream_lists(stream(spark, tmp_path / "in"), trending, shelf, buckets=8)
    q = jobs.store_lists(lists, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
    q.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert 0 < max(kept) <= 8  # state of 100 users
    got, have = {}, {}
    for user, products in rows(spark.read.parquet(str(tmp_path / "out")).orderBy("batch_id"), "user_id", "product_ids"):
        got.setdefault(user, []).append(products)
    want = {}
    for k, back in enumerate((9, 7, 6, 2, 1)):
        now = static(spark, tmp_path / "in" / f"{k:03d}.json")
        newest = {r.user_id: r.t.replace(tzinfo=None) for r in now.groupBy("user_id").agg(F.max("ts").alias("t")).collect()}
        old = [(u, have[u][0]) for u in newest if u in have and newest[u] - have[u][1] <= refresh_state.LIFE]
        old = spark.createDataFrame(old, "user_id bigint, product_ids array<bigint>")
        for user, products in rows(refresh_recommendations(now, old, trending, shelf)):
            have[user] = (products, newest[user])
            want.setdefault(user, []).append(products)
    assert got == want


def test_entries_of_an_active_user_are_combined(spark, shop):
    events = shop.events([(1, "product_view", {"category": "A", "product_id": str(k % 3)}, k) for k in range(900)])
    got = refresh_state.interest_entries(events.coalesce(1)).collect()
    assert len(got) == 3 and sum(r.n for r in got) == 900 and max(r.ts for r in got).replace(tzinfo=None) == AS_OF


def test_sessions_close_by_their_timers(spark, tmp_path):
    beat = lambda tab, age: line(1, "heartbeat", age, tab)
    steps = [
        [beat("a", 9000), beat("a", 8800), beat("a", 8500), beat("b", 8700), beat(None, 8700), *[beat("c", 8600 - k) for k in range(50)]],
        [beat("a", 8201), beat("b", 8399)],  # 299 and 301 seconds later
        [beat("a", 3000)],
        [beat("z", 0)],
    ]
    write_lines(tmp_path / "in", steps)
    got = drain(session_state.closed_sessions(stream(spark, tmp_path / "in")), "append", tmp_path, "closed")
    age = lambda t: round((AS_OF - t.replace(tzinfo=None)).total_seconds())
    seen = sorted((r.session_id, age(r.started_at), age(r.last_activity), r.heartbeats) for r in got.collect())
    # the last one of a closes too: the watermark is ten minutes before z; z stays open
    assert seen == [("a", 3000, 3000, 1), ("a", 9000, 8201, 4), ("b", 8399, 8399, 1), ("b", 8700, 8700, 1), ("c", 8600, 8551, 50)]
    with pytest.raises(ValueError):
        session_state.closed_sessions(static(spark, tmp_path / "in"), timedelta(seconds=30))


def test_many_sessions_share_few_groups(spark, tmp_path):
    rng = random.Random(21)
    beats = [sorted((rng.randrange(3000 * (2 - b), 3000 * (3 - b)), f"s{rng.randrange(120)}") for _ in range(300)) for b in range(3)]
    write_lines(tmp_path / "in", [*([line(1, "heartbeat", age, tab) for age, tab in b] for b in beats), [line(1, "heartbeat", -9000, "z")]])
    out = session_state.closed_sessions(stream(spark, tmp_path / "in"), buckets=8, delay="0 seconds")
    writer = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / "cp"))
    q = writer.trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert 0 < max(kept) <= 8  # state of 120 sessions
    want = {}
    for age, tab in sorted((x for b in beats for x in b), reverse=True):
        runs = want.setdefault(tab, [])
        if runs and runs[-1][1] - age <= 300:
            runs[-1] = (runs[-1][0], age, runs[-1][2] + 1)
        else:
            runs.append((age, age, 1))
    age = lambda t: round((AS_OF - t.replace(tzinfo=None)).total_seconds())
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    seen = sorted((r.session_id, age(r.started_at), age(r.last_activity), r.heartbeats) for r in got)
    assert seen == sorted((tab, *run) for tab, runs in want.items() for run in runs)


def test_timeline_levels_equal_the_batch(spark, tmp_path):
    write_lines(tmp_path / "in", [*shop_batches(7), [line(1, "search", -90_000, query="x")]])
    got = drain(stateful.stream_timeline_levels(as_interactions(stream(spark, tmp_path / "in"))), "append", tmp_path, "levels")
    minutes = rows(stateful.stream_timeline(as_interactions(static(spark, tmp_path / "in"))))
    want = {}
    for bucket, *counts in minutes:
        if bucket.replace(tzinfo=None) < AS_OF:
            want.setdefault(bucket.replace(minute=0), []).append(counts)
    want = {k: (*(sum(c) for c in zip(*v, strict=True)), len(v), max(map(sum, v))) for k, v in want.items()}
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want


def test_live_users_by_hand(spark):
    rng, day = random.Random(12), datetime(2024, 1, 30)
    ids = [1, 2, 32_768, 32_769, 70_000, 0, -5, None]
    seen = [(rng.choice(ids), day + timedelta(seconds=rng.randrange(4 * 3600))) for _ in range(150)]
    frame = spark.createDataFrame(seen, "user_id bigint, ts timestamp_ntz")
    until = day + timedelta(hours=5)
    got = dashboards.live_users(stateful.stream_user_minutes(frame), until, hours=4)
    want = {}
    for k in range(61, 301):
        end = day + timedelta(minutes=k)
        spans = [{u for u, t in seen if u is not None and end - timedelta(minutes=m) <= t < end} for m in (60, 5)]
        if spans[0]:
            want[end] = tuple(map(len, spans))
    found = {r.minute_end.replace(tzinfo=None): (r.total_users, r.active_users) for r in got.collect()}
    assert found == want


def test_refresh_by_hand(spark, shop):
    events = shop.events(
        [
            (1, "product_view", {"category": "A", "product_id": "1"}, 5),
            (1, "click", {"category": "B", "product_id": "22"}, 4),
            (1, "click", {"category": "B", "product_id": "2"}, 3),
            (2, "search", {"query": "x"}, 2),
            (3, "page_view", {}, 1),
        ]
    )
    trending = spark.createDataFrame([(k, k) for k in range(1, 8)], "product_id bigint, rank int")
    shelf = spark.createDataFrame(
        [("A", 11, 1), ("A", 1, 2), ("A", 13, 3), ("A", 14, 4), ("B", 21, 1), ("B", 22, 2), ("B", 23, 3)],
        "category string, product_id bigint, rank int",
    )
    stored = spark.createDataFrame([(1, [99, 4]), (5, [7])], "user_id bigint, product_ids array<bigint>")
    got = dict(rows(refresh_recommendations(events, stored, trending, shelf)))
    # seen products 1, 2 and 22 are out; B is the stronger interest
    assert got == {1: [3, 4, 5, 21, 23, 11, 13, 99], 2: [1, 2, 3, 4, 5]}


def test_sessions_stream(spark, tmp_path):
    write_lines(
        tmp_path / "in",
        [
            [line(1, "beat", 600, "tab_a"), line(1, "beat", 500, "tab_b")],
            [line(1, "beat", 10, "tab_a"), line(None, "beat", 20, "tab_c")],
            [line(1, "beat", 700, "tab_a"), line(2, "beat", 5, "tab_c")],
        ],
    )
    store = str(tmp_path / "sessions")
    jobs.stream_sessions(stream(spark, tmp_path / "in"), store, str(tmp_path / "cp"), True).awaitTermination()
    got = {
        r.session_id: (r.user_id, (AS_OF - r.last_activity).total_seconds())
        for r in keyed.read_keyed(spark, store, ["session_id"], AS_OF).collect()
    }
    assert got == {"tab_a": (1, 10.0), "tab_b": (1, 500.0), "tab_c": (2, 5.0)}


def test_replayed_refresh_gives_what_one_run_gives(spark, shop, tmp_path):
    events = shop.events([(1, "product_view", {"category": "A", "product_id": "1"}, 5)])
    trending = spark.createDataFrame([(8, 1)], "product_id bigint, rank int")

    def shelf(*ids):
        data = [("A", p, k) for k, p in enumerate(ids, 1)]
        return lambda: (trending, spark.createDataFrame(data, "category string, product_id bigint, rank int"))

    once, twice = str(tmp_path / "once"), str(tmp_path / "twice")
    jobs.refresh_batch(events, 0, once, shelf(9, 11))
    jobs.refresh_batch(events, 0, twice, shelf(1, 2, 3))
    jobs.refresh_batch(events, 0, twice, shelf(9, 11))
    one, two = (rows(keyed.read_keyed(spark, s, ["user_id"], AS_OF), "user_id", "product_ids") for s in (once, twice))
    assert one == two


def test_stream_and_batch_in_one_store(spark, shop, tmp_path):
    store = str(tmp_path / "store")
    lists = spark.createDataFrame([(1, [70, 71]), (2, [72])], "user_id bigint, product_ids array<bigint>")
    early = AS_OF - timedelta(hours=1)
    keyed.publish_keyed(lists, store, ["user_id"], keyed.TTL["recommendations"], early, 1_714_561_200, "batch")
    trending = spark.createDataFrame([(8, 1)], "product_id bigint, rank int")
    shelf = spark.createDataFrame([("A", 9, 1)], "category string, product_id bigint, rank int")
    events = shop.events([(1, "product_view", {"category": "A", "product_id": "1"}, 5)])
    for writer in ("refresh-a", "refresh-b"):  # the second checkpoint starts at batch 0 again
        jobs.refresh_batch(events, 0, store, lambda: (trending, shelf), writer)
    got = dict(rows(keyed.read_keyed(spark, store, ["user_id"], AS_OF), "user_id", "product_ids"))
    assert got[1][:2] == [8, 9] and set(got[1]) == {8, 9, 70, 71} and got[2] == [72]


def test_counter_stream_publishes_totals(spark, tmp_path):
    write_lines(tmp_path / "in", shop_batches(3))
    counts = stateful.stream_product_counters(stream(spark, tmp_path / "in"))
    store = str(tmp_path / "store")
    keys, ttl = ["product_id", "action"], keyed.TTL["product_stats"]
    jobs.publish_counts(counts, store, keys, str(tmp_path / "cp"), ttl, available_now=True).awaitTermination()
    got = keyed.read_keyed(spark, store, keys, AS_OF)
    want = stateful.stream_product_counters(static(spark, tmp_path / "in"))
    assert sorted(rows(got, "product_id", "action", "count")) == sorted(rows(want, "product_id", "action", "count"))
    # a row lives from its newest event on, not from the start of the stream
    assert keyed.read_keyed(spark, store, keys, AS_OF + timedelta(days=29)).count() == got.count()
    assert keyed.read_keyed(spark, store, keys, AS_OF + timedelta(days=31)).count() == 0
    profile = stateful.stream_profile_counters(stream(spark, tmp_path / "in"))
    store2, keys = str(tmp_path / "store2"), ["user_id", "kind", "value"]
    jobs.publish_counts(
        profile, store2, keys, str(tmp_path / "cp2"), keyed.TTL["user_profile"], available_now=True
    ).awaitTermination()
    got = keyed.read_keyed(spark, store2, keys, AS_OF)
    want = aggregates.user_profile_counters(static(spark, tmp_path / "in"))
    assert sorted(rows(got, "user_id", "kind", "value", "count")) == sorted(rows(want))


def test_dedup_stream(spark, tmp_path):
    write_lines(
        tmp_path / "in",
        [
            [line(1, "product_view", 100, event_id="a", product_id=1), line(1, "product_view", 100, event_id="a", product_id=1),
             line(1, "product_view", 99, event_id="b", product_id=1)],
            [line(1, "product_view", 90, event_id="a", product_id=1), line(2, "product_view", 90, event_id="c", product_id=1)],
        ],
    )
    once = drain(stateful.dedup_events(stream(spark, tmp_path / "in")), "append", tmp_path, "id")
    assert sorted(r[0] for r in rows(once, "event_id")) == ["a", "b", "c"]


def test_dedup_by_content_loses_no_event(spark, tmp_path):
    searches = [line(1, "search", 50, "s", f"q{k}", query=f"word {k}") for k in range(5)]
    double = [line(1, "product_view", 40.5, "s", "v1", product_id=3), line(1, "page_load", 40, "s", "v2", product_id=3)]
    again = [line(1, "product_view", 30, "s", "v3", product_id=3), line(2, "product_view", 40, "s", "v4", product_id=3)]
    nameless = [line(None, "product_view", 40, None, f"n{k}", product_id=3) for k in range(2)]
    write_lines(tmp_path / "in", [searches + double, again + nameless, [line(9, "x", -90000, "z", "end")]])
    kept = drain(stateful.dedup_events(stream(spark, tmp_path / "in"), by_content=True), "append", tmp_path, "content")
    want = {*(f"q{k}" for k in range(5)), "v1", "v3", "v4", "n0", "n1"}
    assert sorted(r[0] for r in rows(kept, "event_id")) == sorted(want)
    batch = stateful.dedup_events(static(spark, tmp_path / "in"), by_content=True)
    assert sorted(r[0] for r in rows(batch, "event_id")) == sorted(want | {"end"})


def test_timeline_stream_equals_batch(spark, tmp_path):
    rng = random.Random(9)
    lines = [line(1, rng.choice(["product_view", "product_card_click", "recommendation_click"]), age, event_id=str(age), product_id=2, action="x")
             for age in range(4000, 1000, -7)]
    late = [line(1, "product_view", -90000, event_id="z", product_id=1)]
    write_lines(tmp_path / "in", [lines[:200], lines[200:], late])
    got = drain(stateful.stream_timeline(as_interactions(stream(spark, tmp_path / "in"))), "append", tmp_path, "line")
    want = stateful.stream_timeline(as_interactions(static(spark, tmp_path / "in"))).filter(
        F.col("bucket") < F.lit(AS_OF)
    )
    assert sorted(rows(got)) == sorted(rows(want)) and got.count() > 40


def test_gap_session_stream(spark, tmp_path):
    lines = [line(1, "x", a, event_id=str(a)) for a in (5000, 4900, 4000, 3990)] + [line(2, "x", 4100, event_id="q")]
    write_lines(tmp_path / "in", [lines, [line(3, "x", -90000)]])
    got = drain(stateful.stream_gap_sessions(stream(spark, tmp_path / "in")), "append", tmp_path, "gap")
    assert sorted(rows(got, "user_id", "event_count")) == [(1, 2), (1, 2), (2, 1)]


def test_engagement(shop):
    events = shop.events(
        [
            (1, "page_load", {"page": "/a", "load_time": "100"}, 9), (1, "page_load", {"page": "/a", "load_time": "200"}, 8),
            (1, "scroll_depth", {"page": "/a", "depth": "40"}, 7), (1, "scroll_depth", {"page": "/a", "depth": "90"}, 6),
            (1, "page_blur", {"page": "/a", "time_spent": "1000"}, 5), (1, "page_unload", {"page": "/a", "time_spent": "500"}, 4),
            (1, "scroll_depth", {"page": "/b", "depth": "x"}, 3), (2, "mouse_position", {"page": "/a"}, 2),
        ]
    )
    got = sorted(rows(stateful.engagement_events(events)))
    assert got == [(1, "/a", 90.0, 1500.0, 150.0), (1, "/b", None, None, None)]
