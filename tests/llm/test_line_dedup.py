import random

import numpy as np

from clickloom.llm import line_dedup


def plain(rows):
    """Component of each distinct line, by comparing all pairs of lines."""
    texts = sorted({line.strip(" \t\r").lower() for _, t in rows for line in (t or "").split("\n")} - {""})
    sets = [line_dedup.shingles(t) for t in texts]
    label = list(range(len(texts)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    return {t: find(k) for k, t in enumerate(texts)}


def sample(rng):
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(200)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    for _ in range(120):
        line = rng.choice(lines).split(" ")
        for _ in range(rng.randint(0, 3)):
            line[rng.randrange(len(line))] = rng.choice(words)
        lines.append(" ".join(line))
    return [(k, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9)))) for k in range(80)]


def check(rows, got):
    part = plain(rows)
    lines = {(i, k): part[x.strip(" \t\r").lower()] for i, t in rows for k, x in enumerate((t or "").split("\n")) if x.strip(" \t\r")}
    assert {(r.doc_id, r.line_no) for r in got} == set(lines)
    first = {}
    for at in sorted(lines):
        first.setdefault(lines[at], at)
    ours = {}
    for r in got:
        at = (r.doc_id, r.line_no)
        assert (r.kept_doc_id, r.kept_line_no) == first[lines[at]]
        assert r.kept == (first[lines[at]] == at)
        ours.setdefault(r.component_id, set()).add(lines[at])
    assert all(len(v) == 1 for v in ours.values())


def test_equals_all_pairs(frame):
    rows = sample(random.Random(4))
    check(rows, line_dedup.duplicate_lines(frame(rows)).collect())


def test_tiles_lose_no_link(frame, monkeypatch):
    monkeypatch.setattr(line_dedup, "TILE", 3)
    rows = sample(random.Random(5))
    check(rows, line_dedup.duplicate_lines(frame(rows)).collect())


def test_bands_find_pairs_at_the_threshold():
    rng = random.Random(6)
    met = total = 0
    for _ in range(400):
        base = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300))
        other = base[:-30] + "".join(rng.choice("0123456789") for _ in range(30))
        a, b = line_dedup.shingles(base), line_dedup.shingles(other)
        assert 0.78 < len(a & b) / len(a | b) < 0.86
        keys = line_dedup.band_keys([base, other])
        met += bool((keys[0] == keys[1]).any())
        total += 1
    assert met >= 0.985 * total and line_dedup.expected_recall(0.8) > 0.995


def test_signatures_depend_on_the_set_of_shingles_alone():
    texts = ["abcabcabcabcabc", "abcabcabcabcabcabc", "ab", "ab", "日本語のテキストです", "x" * 9, "x" * 500]
    keys = line_dedup.band_keys(texts)
    same = [(i, j) for i in range(7) for j in range(i) if (keys[i] == keys[j]).all()]
    sets = [line_dedup.shingles(t) for t in texts]
    assert same == [(i, j) for i in range(7) for j in range(i) if sets[i] == sets[j]]
    alone = np.vstack([line_dedup.band_keys([t]) for t in texts])
    assert (alone == keys).all()


def test_odd_rows(odd, nothing):
    got = line_dedup.duplicate_lines(odd).collect()
    assert {r.doc_id for r in got} == {1, None, 5, 6, 7}
    assert all(r.kept_doc_id == 1 for r in got if r.doc_id is None)
    assert line_dedup.duplicate_lines(nothing).collect() == []


def test_text_without_repeated_lines(frame, odd):
    docs = frame([(1, "keep this line\n\nand that one\nKEEP this line "), (2, "keep this line"), (3, "new here"), (4, None)])
    out = line_dedup.drop_duplicate_lines(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "keep this line\n\nand that one", 2: "", 3: "new here", 4: None}
    assert line_dedup.drop_duplicate_lines(odd).count() == odd.count()


def test_large_groups_link_what_all_pairs_link():
    rng = random.Random(7)
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(160)]
    lines = set()
    for _ in range(160):  # a tight core, lines at the edge of the threshold and beyond
        own = base[:]
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(160)] = rng.choice("0123456789")
        lines.add("".join(own))
    lines = sorted(lines) + ["short", "shorter", "shorter!"]
    part = plain([(0, "\n".join(lines))])
    for residents in (len(lines), 60):
        group = line_dedup.Group(list(range(residents)), lines[:residents], 0.8)
        links = group.settle()
        for k in range(residents, len(lines)):
            links += group.visit(k, lines[k])
        for a, b in links:
            x, y = line_dedup.shingles(lines[a]), line_dedup.shingles(lines[b])
            assert len(x & y) >= 0.8 * len(x | y)
        if residents < len(lines):
            rest = line_dedup.Group(list(range(residents, len(lines))), lines[residents:], 0.8)
            links += rest.settle()
        label = list(range(len(lines)))
        for a, b in links:
            label = [label[b] if x == label[a] else x for x in label]
        ours = {}
        for k, line in enumerate(lines):
            ours.setdefault(label[k], set()).add(part[line])
        assert all(len(v) == 1 for v in ours.values()) and len(ours) == len(set(part.values()))


def test_codes_decide_like_sets_of_shingles():
    rng = random.Random(9)
    wide = ["日本語のテキスト", "ÿ", "Ā", "\U0001f600", "\0"]
    lines = ["", "ab", "ab\0", "a" * 8, "a" * 400, "\0" * 9]
    for _ in range(60):
        line = "".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 60)))
        lines += [line, line + rng.choice(wide), line[:-1], rng.choice(wide) + line[1:], line + line[:4]]
    sets = [line_dedup.shingles(x) for x in lines]
    held = line_dedup.Lines(lines, 0.8)
    for i, own in enumerate(held.codes):
        for j in range(i):
            assert held.similar(lines[i], own, j) == line_dedup.similar(sets[i], sets[j])


def test_repeated_code_values_keep_lines_apart(monkeypatch):
    monkeypatch.setattr(line_dedup, "shingle_hashes", lambda points: np.zeros(len(points) - 7, np.uint64))
    lines = ["ひとつめの行はこのとおりです", "ふたつめの行はまったく別の話です", "ひとつめの行はこのとおりです。"]
    assert line_dedup.few_links(lines, 0.8) == [(2, 0)]


def test_trimming_takes_all_blanks_at_both_ends(spark):
    from pyspark.sql import functions as F

    texts = ["", " ", "a", " A", "a\t ", "\r\x0b\x0c x y \r", "\xa0z", "\tb"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(line_dedup.normal_line(F.col("t"))).collect()]
    assert got == [t.strip(" \t\r\x0b\x0c").lower() for t in texts]


def test_buckets_pass_by_in_batches():
    import pyarrow as pa

    rng = random.Random(10)
    rows = sorted((rng.randint(-9, 9), rng.randint(-40, 40)) for _ in range(300))
    buckets = {}
    for band, key in rows:
        buckets.setdefault(band, set()).add(key)
    wanted = {(min(v), k) for v in buckets.values() if len(v) > 1 for k in v}
    names = ["band", "line_key"]
    for size in (1, 7, 1000):
        parts = [rows[k : k + size] for k in range(0, len(rows), size)]
        parts = [pa.record_batch([pa.array(c, pa.int64()) for c in zip(*p, strict=True)], names) for p in parts]
        got = [tuple(r.values()) for b in line_dedup._led(iter(parts)) for r in b.to_pylist()]
        assert set(got) == wanted
