import random
import re

import numpy as np
import xxhash

from clickloom.llm import simhash
from clickloom.llm.graph import connected_components


def plain_fingerprint(text, width=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance):
    """Smallest index reachable, by comparing all pairs."""
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(prints))]


def flipped(rng, bits, n):
    for b in rng.sample(range(64), n):
        bits ^= 1 << b
    return bits


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_equals_plain():
    rng = random.Random(3)
    texts = ["", None, "A", "a b c", "a B c D", "é É x y z", "\x00 a b c d e"]
    texts += [" ".join(rng.choice("abcdeABÄ") * rng.randint(1, 3) for _ in range(rng.randint(1, 60))) for _ in range(80)]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_anchors_cover_and_reach():
    rng = np.random.default_rng(5)
    for _, width in simhash.blocks(4):
        code = simhash.Covering(width)
        words = rng.integers(0, 1 << width, 300, dtype=np.uint64)
        near = {int(w): set() for w in words}
        homes = {}
        for rows, at, home in code.anchors(words):
            assert (np.bitwise_count(words[rows] ^ at) <= code.REACH).all()
            assert (code.syndrome(at) == 0).all()
            for w, a, h in zip(words[rows].tolist(), at.tolist(), home.tolist(), strict=True):
                near[w].add(a)
                if h:
                    homes[w] = a
        assert set(homes) == set(near)  # each word has a home within the covering radius
        for w in words[:50].tolist():
            for b in range(width):  # and is at home at an anchor of each word within one bit
                other = np.array([w ^ (1 << b)], np.uint64)
                reached = {int(a) for _, at, _ in code.anchors(other) for a in at}
                assert homes[w] in reached


def test_links_equal_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    prints = {0, (1 << 64) - 1}
    for _ in range(40):
        at = rng.getrandbits(64)
        prints.add(at)
        for _ in range(rng.randint(0, 12)):
            at = flipped(rng, at, rng.randint(1, 6))  # chains, near and just too far
            prints.add(at)
    prints |= {1, 3, 7, 15, 31, 63}
    prints = sorted(prints)
    want = plain_components(prints, 4)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
    roots = dict(map(tuple, connected_components(simhash.fingerprint_links(frame, 4)).collect()))
    groups = {}
    for p, w in zip(prints, want, strict=True):
        groups.setdefault(w, set()).add(roots.get(signed(p), signed(p)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_large_cells_and_tiles_lose_no_link(spark, monkeypatch):
    rng = random.Random(12)
    base = rng.getrandbits(64)
    prints = sorted({flipped(rng, base, rng.randint(0, 8)) for _ in range(2600)})
    want = plain_components(prints[:400], 4)
    bits = np.array(prints[:400], np.uint64)
    a, b = simhash.LargeCell(4).links(bits, np.ones(400, bool))
    index = {int(p): k for k, p in enumerate(bits)}
    label = simhash._roots(400, np.array([index[int(x)] for x in a]), np.array([index[int(x)] for x in b]))
    assert len(set(zip(label.tolist(), want, strict=True))) == len(set(want)) == len(set(label.tolist()))
    assert len(a) < 400  # spanning links, not all pairs

    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
    whole = dict(map(tuple, connected_components(simhash.fingerprint_links(frame, 4)).collect()))
    monkeypatch.setattr(simhash, "TILE", 100)
    tiled = dict(map(tuple, connected_components(simhash.fingerprint_links(frame, 4)).collect()))
    assert whole == tiled


def test_odd_rows(odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].fingerprint == "0" * 16 and by_id[3].component_id == by_id[4].component_id == 2
    assert by_id[1].component_id == 1
    assert {r.component_id for r in rows if r.doc_id is None} == {1, 2}
    assert simhash.near_duplicates(nothing).collect() == []


def test_one_row_of_each_group_stays(frame, odd):
    text = "a b c d e f g h i j k l m n o p"
    docs = frame([(9, text), (5, text), (5, text), (7, text.upper()), (8, "quite another text of six words")])
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 8]
    assert simhash.drop_near_duplicates(odd).count() == len({r.component_id for r in simhash.near_duplicates(odd).collect()})


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 90), (90, 95), (7, 7), (None, 3)]
    roots = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert roots == {k: 0 for k in range(61)} | {90: 90, 95: 90, 100: 90}
