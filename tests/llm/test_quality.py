import random
import re
import zlib

import numpy as np

from clickloom.llm import quality_classifier as qc
from clickloom.llm import quality_rules as qr


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_upper": len(re.findall("[A-Z]", text)), "n_letters": len(re.findall("[A-Za-z]", text)),
    }


def texts():
    rng = random.Random(3)
    parts = ["a", "B", "é", "#", "*x", "\n", "\t", "\x0b", "\x0c", "\r", " ", " ", "😀", "cc", "a", "a"]
    return ["", None, " \n "] + [rng.choice(["", " "]).join(rng.choice(parts) for _ in range(rng.randint(1, 120))) for _ in range(150)]


def test_measures_equal_plain():
    for t in texts():
        got = dict(zip(("doc_id", *qr.MEASURES), qr.measure(1, t), strict=True))
        for name, value in plain_measures(t).items():
            assert got[name] == value, (name, t)


def test_repeated_windows_with_many_words():
    ids = np.array([5_000_000, 1, 2, 9, 5_000_000, 1, 2, 7])
    assert qr.repeated_window_words(ids) == 6


def test_ledger_policies_and_ablations(frame, odd, nothing):
    rng = random.Random(5)
    clean = lambda: " ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(60))
    docs = [(1, clean()), (2, "word " * 60), (3, "few words"), (4, clean().upper()), (5, clean().replace(" ", "*** "))]
    rows = qr.ledger(frame(docs)).cache()
    bits = {r.doc_id: r.failed_bits for r in rows.collect()}
    assert bits[1] == 0 and bits[2] & qr.bits("repeated_windows") and bits[3] & qr.bits("few_words")
    assert bits[4] == qr.bits("upper_case") and bits[5] == qr.bits("many_symbols")
    for policy, mask in qr.POLICIES.items():
        assert {r.doc_id: r.kept for r in qr.judge(rows, policy).collect()} == {i: not b & mask for i, b in bits.items()}
    mask = qr.POLICIES[qr.CURRENT]
    for r in qr.ablations(rows).collect():
        bit = qr.bits(r.rule)
        assert r.failed == sum(bool(b & bit) for b in bits.values())
        assert r.alone == sum(b & mask == bit for b in bits.values())
        assert r.kept_without == sum(not b & (mask & ~bit) for b in bits.values())
    assert qr.ledger(odd).count() == odd.count()
    assert qr.judge(qr.ledger(nothing)).collect() == [] and qr.ablations(qr.ledger(nothing)).collect() == []


def test_isotonic_is_the_least_squares_fit():
    rng = np.random.default_rng(0)
    for _ in range(40):
        n = rng.integers(1, 9)
        values, counts = np.arange(n, dtype=float), rng.integers(1, 5, n).astype(float)
        sums = rng.integers(0, 9, n).astype(float)
        knots, levels = qc.isotonic(values, sums, counts)
        assert (np.diff(levels) > 0).all() and (np.diff(knots) > 0).all()
        mean = sums / counts
        # the min-max formula of isotonic regression
        want = [
            max(min((sums[a : b + 1].sum() / counts[a : b + 1].sum()) for b in range(k, n)) for a in range(k + 1))
            for k in range(n)
        ]
        assert np.allclose(sorted(set(np.round(want, 9))), np.round(levels, 9)), mean


def test_random_features_approximate_the_kernel():
    z = np.random.default_rng(1).standard_normal((40, 14))
    waves = qc.random_features(z)[:, :-1]
    kernel = np.exp(-((z[:, None] - z[None]) ** 2).sum(-1) / (2 * 14))
    assert np.abs(waves @ waves.T - kernel).max() < 0.35 and np.abs(waves @ waves.T - kernel).mean() < 0.06


def test_held_out_accuracy_and_folds(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = qc.quality_scores(docs, labels)
    marked = {r.doc_id: r.quality for r in labels.collect()}
    got = rows.collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in marked]
    assert np.mean([r.predicted == marked[r.doc_id] for r in held]) > 0.95
    good = [r.score for r in held if marked[r.doc_id] == 1]
    poor = [r.score for r in held if marked[r.doc_id] == 0]
    assert np.mean([a > b for a in good for b in poor]) > 0.97
    kept = qc.drop_rejected(docs, labels)
    assert kept.columns == docs.columns
    same = {r.doc_id for r in kept.select("doc_id").collect()} ^ {r.doc_id for r in got if r.predicted}
    assert len(same) <= 2  # sums in another order may move a score that is on the edge


def test_held_out_labels_are_never_read(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) as quality")
    a = {r.doc_id: r.score for r in qc.quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in qc.quality_scores(docs, turned).collect()}
    assert all(abs(a[k] - b[k]) < 1e-6 for k in a)


def test_odd_rows_and_labels(odd, nothing, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (9, 5)], "doc_id bigint, quality int")
    for marks in (labels, labels.limit(0)):
        got = qc.quality_scores(odd, marks).collect()
        assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
        assert qc.quality_scores(nothing, marks).collect() == []
        assert qc.drop_rejected(odd, marks).columns == odd.columns
    assert {r.score for r in qc.quality_scores(odd, labels.limit(0)).collect()} == {0.5}


def test_parts_without_rows_send_no_sums(spark, monkeypatch):
    rows = spark.range(0, 40, 1, 30).where("id < 4")  # all but a few of 30 parts are empty
    sent = []
    collect = type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda df: sent.append(collect(df)) or sent[-1])
    values = lambda got: np.array([got.num_rows, sum(got.column(0).to_pylist())], float)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert qc._summed(rows, values, 2).tolist() == [4, 6]
        assert qc._summed(rows.where("id < 0"), values, 2).tolist() == [0, 0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert 1 <= len(sent[0]) <= 4 and not sent[1]
