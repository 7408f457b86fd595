import random
import re

from clickloom.llm import decontamination as d


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text, items, width=10):
    words, hit, found = plain_words(text), set(), set()
    for item, body in items:
        own = plain_words(body)
        size = min(width, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == own[k : k + size]:
                    hit |= set(range(at, at + size))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def test_equals_plain_search(frame, spark, monkeypatch):
    rng = random.Random(8)
    vocabulary = ["a", "b", "c", "Dd", "é", "7"]
    body = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, body(rng.choice([1, 2, 3, 9, 10, 11, 30]))) for k in range(2, 14)] + [(20, None), (21, "..."), (None, "a b")]
    items += [(3, items[1][1]), (30, items[4][1])]
    docs = []
    for k in range(60):
        part = rng.choice(items)[1] or ""
        docs.append((k, body(rng.randint(0, 40)) + "-" + part.upper().replace("É", "é") + ", " + body(rng.randint(0, 20))))
    docs += [(100, None), (101, ""), (102, "!?"), (7, docs[7][1])]
    table = spark.createDataFrame([(*i, 1) for i in items], "item_id bigint, text string, n_hit int")
    want = {i: plain(t, [x for x in items if x[0] is not None]) for i, t in docs}
    for block in (d.BLOCK, 20):  # one automaton, and several in turn
        monkeypatch.setattr(d, "BLOCK", block)
        got = d.contamination(frame(docs), table).collect()
        assert len(got) == len(docs)
        for r in got:
            assert (r.n_words, r.n_hit, list(r["items"])) == want[r.doc_id]
            assert r.contaminated == (r.n_hit > 0) and r.n_items == len(r["items"])
            assert sum(r.ends) - sum(r.starts) == r.n_hit
        clean = d.drop_contaminated(frame(docs), table)
        assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _ in docs if not want[i][1])


def test_jumps_never_pass_an_occurrence():
    rng = random.Random(9)
    for _ in range(300):
        text = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 40))]
        size = rng.randint(1, 5)
        patterns = {tuple(rng.choice([b"a", b"b", b"c"]) for _ in range(size)): ["x"] for _ in range(rng.randint(1, 4))}
        want = {(k, p) for p in patterns for k in range(len(text) - size + 1) if tuple(text[k : k + size]) == p}
        assert set(d.WuManber(patterns).occurrences(text)) == want


def test_odd_rows(odd, nothing, spark):
    items = spark.createDataFrame([(1, "three four")], "item_id bigint, text string")
    got = d.contamination(odd, items).collect()
    assert len(got) == odd.count() and sum(r.contaminated for r in got) == 3
    assert d.contamination(nothing, items).collect() == []
    assert not any(r.contaminated for r in d.contamination(odd, items.limit(0)).collect())
