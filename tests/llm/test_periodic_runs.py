"""Periodic runs against plain comparison of all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from clickloom.llm import periodic_runs as pr


def plain_runs(words):
    """All runs by comparing every word with the one a period later."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words):
    gone = {i for s, n, q in plain_runs(words) for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def texts(seed):
    rng = random.Random(seed)
    out = ["", "a", "a a a a a", "a a a a a a", "a b " * 4, "x a b a b a b a b a y", "a a b " * 5 + "a", "ab " * 40 + "cd " * 40]
    for _ in range(120):
        n, k = rng.choice([5, 6, 7, 30, 150, 400]), rng.choice([1, 2, 3, 40])
        t = [str(rng.randrange(k)) for _ in range(n)]
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(3, 10)
        if rng.random() < 0.7:
            t = [t[i] if i < a else t[a + (i - a) % p] for i in range(n)]
        out.append(rng.choice([" ", "\n", " \t\x0b"]).join(t))
    return out


def test_cover_meets_every_pair():
    assert all({(a + int(pr.STEPS[a, b])) % 31, (b + int(pr.STEPS[a, b])) % 31} <= set(pr.COVER) for a in range(31) for b in range(31))


def test_extensions_equal_plain_comparison():
    rng = np.random.default_rng(3)
    words = np.append(np.tile(rng.integers(1, 3, 50), 8), 99)
    a, b = rng.integers(0, 400, (2, 3000))
    a, b = a[a != b], b[a != b]
    want = [next(k for k in range(500) if words[max(x, y) + k] != words[min(x, y) + k]) for x, y in zip(a, b, strict=True)]
    assert pr.Extensions(words)(a, b).tolist() == want


@pytest.mark.parametrize("volume", [pr.WORDS, 50])
def test_runs_equal_plain_runs(frame, monkeypatch, volume):
    monkeypatch.setattr(pr, "WORDS", volume)
    rows = list(enumerate(texts(volume)))
    got = pr.periodic_runs(frame(rows)).collect()
    want = {i: (len(t.split()), plain_runs(t.split()), plain_collapsed(t.split())) for i, t in rows}
    assert {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got} == want


def test_grid_in_small_steps(monkeypatch):
    monkeypatch.setattr(pr, "PLACES", 40)
    words = ["a", "b", "c"] * 30 + ["d"] * 20
    ids = np.array([ord(w) for w in words] + [1000])
    found = pr.find_runs(ids, np.array([0]), np.array([len(words)]))
    assert list(zip(*(x.tolist() for x in found[1:]), strict=True)) == plain_runs(words)


def test_report_of_planted_documents(frame):
    rows = list(enumerate(texts(5) * 3))
    got = {r.doc_id: r for r in pr.run_report(pr.plant_runs(frame(rows))).collect()}
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 20
    for i, text in rows:
        words = planted(i, text.split())
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapsed(words).encode()).hexdigest()


def test_odd_rows(odd, nothing):
    rows = pr.run_report(pr.plant_runs(odd)).collect()
    assert len(rows) == odd.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.n_runs == 0 and r.collapsed_sha256 == empty and r.start is None for r in rows if r.doc_id in (2, 3, 4, 8))
    long = next(r for r in rows if r.doc_id == 6)
    assert (long.n_runs, long.start, long.length, long.period) == (1, 0, 30_000, 1)
    assert pr.run_report(pr.plant_runs(nothing)).count() == 0
