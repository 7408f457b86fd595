"""Packing against the tokenizer's own library, the bound by volume and exhaustive search."""

import random
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from tokenizers import Tokenizer

from clickloom.llm import packing as pk
from clickloom.llm.queries import BYTE_PIECES

TOKENIZER = Tokenizer.from_file(BYTE_PIECES)
TOKENIZER.encode_special_tokens = True


def volume(counts):
    capacity = len(counts) - 1
    return -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)


def checked(counts, patterns):
    """The number of sequences, after a check that they hold every piece once and fit."""
    held = Counter()
    for items, copies in patterns:
        assert copies > 0 and 0 < sum(items) <= len(counts) - 1
        for x in items:
            held[x] += copies
    assert held == Counter({k: int(c) for k, c in enumerate(counts) if c})
    return sum(copies for _, copies in patterns)


def fewest(lengths, capacity):
    """The least number of sequences, by exhaustive search."""

    @cache
    def search(left):
        if not left:
            return 0
        best = len(left)

        def extend(rest, room, at, kept):
            nonlocal best
            best = min(best, 1 + search(tuple(kept + rest[at:]))) if at <= len(rest) else best
            for k in range(at, len(rest)):
                if rest[k] <= room:
                    extend(rest, room - rest[k], k + 1, kept + rest[at:k])

        extend(list(left[1:]), capacity - left[0], 0, [])
        return best

    return search(tuple(sorted(lengths, reverse=True)))


def test_prices_equal_plain_knapsack():
    rng = np.random.default_rng(1)
    lengths, prices = np.array([3, 4, 7, 11]), rng.random(4)
    best, taken = pk.best_prices(prices, lengths, 40)
    plain = [0.0] * 41
    for room in range(1, 41):
        plain[room] = max([plain[room - 1]] + [plain[room - x] + p for x, p in zip(lengths, prices, strict=True) if x <= room])
    assert np.allclose(best, plain)
    assert all(taken[r] in (0, *lengths) for r in range(41))


def test_a_solution_covers_its_share_and_no_more():
    counts = np.random.default_rng(2).integers(0, 5000, 129)
    counts[128] = 0
    used = np.zeros(129)
    for items, amount in pk.solve(counts, 128).items():
        assert sum(items) <= 128
        for x in items:
            used[x] += amount
    assert (used <= counts * pk.SHARE + 1e-6).all()
    assert used.sum() > 0.1 * counts.sum()


@pytest.mark.parametrize("few", [pk.FEW, 10])
def test_small_cases_are_close_to_the_optimum(monkeypatch, few):
    monkeypatch.setattr(pk, "FEW", few)
    rng, extra = random.Random(4), 0
    for _ in range(40):
        lengths = [rng.randint(1, 20) for _ in range(rng.randint(0, 9))]
        counts = np.bincount(lengths, minlength=21)
        n, best = checked(counts, pk.configurations(counts, 20)), fewest(lengths, 20)
        assert best <= n <= best + 1
        extra += n - best
    assert extra <= 3


@pytest.mark.parametrize("scale", [1, 10**3, 10**9])
def test_close_to_the_volume_at_any_size(scale):
    rng = np.random.default_rng(5)
    counts = np.bincount(rng.integers(1, 257, 60_000), minlength=257) * scale
    counts[64] += 40_000 * scale
    n = checked(counts, pk.configurations(counts, 256))
    assert n <= 1.002 * checked(counts, pk.best_fit(counts, 256))
    assert n <= 1.005 * volume(counts) + 1


def test_lengths_that_cannot_fill_a_sequence():
    counts = np.zeros(1025, np.int64)
    counts[400], counts[600], counts[1023], counts[1024] = 50_000, 10**6, 30_000, 7
    assert checked(counts, pk.configurations(counts)) == 30_007 + 10**6  # each 600 has room for a 400
    counts[:] = 0
    assert pk.configurations(counts) == []


def plain_pieces(doc_id, text, capacity):
    ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]
    first = len(ids) % capacity or capacity
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    return [
        (doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
    ]


def check_places(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@pytest.mark.parametrize("few", [pk.FEW, 5])
def test_pieces_and_places(odd, frame, spark, monkeypatch, few):
    monkeypatch.setattr(pk, "FEW", few)
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choice(["the", "ünter", "x1", "<|endoftext|>", "\n\n", "日本"]) for _ in range(rng.choice([1, 5, 60])))) for k in range(150)]
    docs = odd.union(frame(rows + [(900, rows[3][1])] * 40)).repartition(7)
    got = pk.pack_documents(docs, BYTE_PIECES, 64).collect()
    want = [p for r in docs.collect() for p in plain_pieces(r.doc_id, r.text, 64)]
    key = lambda r: str(tuple(r))
    assert sorted((tuple(r[:5]) for r in got), key=key) == sorted(want, key=key)
    counts = np.bincount([r.length for r in got], minlength=65)
    assert check_places(got, 64) <= 1.02 * volume(counts) + 1


def test_ids_can_be_kept_and_other_columns_are_carried(odd):
    rows = pk.pack_documents(odd, BYTE_PIECES, 1024, ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in rows)
    check_places(rows, 1024)


def test_empty_table(nothing):
    out = pk.pack_documents(nothing, BYTE_PIECES)
    assert out.collect() == []
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
