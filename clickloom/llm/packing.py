"""Packing of tokenised documents into sequences of one capacity.

The pieces are counted by length. A linear program over configurations, the
ways to fill a sequence, covers these counts: multiplicative weights price the
lengths, dynamic programming over the capacity finds the configurations of the
best price. Whole copies of its configurations are taken, what remains is
solved again, and the last few pieces are placed by best fit or by filling the
largest piece's sequence as far as the others can. All of this works on the
histogram, whose size is the capacity, and not on the pieces. Spark numbers the
pieces of each length, and a number finds its place among the configurations.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import batch, durable

CAPACITY = 1024
#: How much more a token of the longest piece is worth at first, how much a length
#: loses by being covered, and the share of a count that one step covers. Each
#: setting is solved to the end, the fewest sequences count.
SETTINGS = ((0.05, 2.0, 0.1), (0.0, 6.0, 0.1))
#: How far a configuration may be from the best price, and the steps of a solution.
NEAR, STEPS = 0.0005, 300
#: The share of the counts that a solution covers; the rest keeps small pieces for the end.
SHARE = 0.9
#: Remaining pieces that are placed without another solution, and the part of them that a last solution leaves.
FEW, STALL = 20_000, 0.998
#: The pattern by which byte-level BPE cuts text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Token places of a batch of pieces with their ids.
TOKENS = 4_000_000

Patterns = list[tuple[tuple[int, ...], int]]


# ------------------------------------------------------- configurations of lengths


def best_prices(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best total price of each room up to ``capacity``, and the length that is taken last there (0: none).

    Of equal prices the longer length is taken, so short pieces stay for later.
    """
    best, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    lengths, prices, total = lengths[::-1], prices[::-1], len(lengths)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if fitting[room]:
            k = total - fitting[room]
            values = best[room - lengths[k:]] + prices[k:]
            j = int(values.argmax())
            if values[j] > best[room] + 1e-12:
                best[room], taken[room] = values[j], lengths[k + j]
    return best, taken


def solve(counts: np.ndarray, capacity: int, setting: tuple[float, float, float] = SETTINGS[0]) -> dict[tuple[int, ...], float]:
    """Configurations and amounts that cover up to ``SHARE`` of the counts, none more than that.

    The price of a length starts near its part of the capacity, the dual solution
    of perfect packing, and falls exponentially as the length is covered. The
    solution ends where the best configuration is less full than the first one.
    """
    gain, decay, step = setting
    worth = np.arange(capacity + 1) / capacity
    worth *= 1 + gain * worth
    need = counts * SHARE
    covered, amounts, full = np.zeros(len(counts)), {}, 0
    for _ in range(STEPS):
        lengths = np.flatnonzero(need - covered > 1e-9 * np.maximum(need, 1))
        if not len(lengths):
            break
        prices = worth[lengths] * np.exp(-decay * covered[lengths] / need[lengths])
        best, taken = best_prices(prices, lengths, capacity)
        values = prices + best[capacity - lengths]
        fresh = set()
        for j in np.flatnonzero(values >= (1 - NEAR) * best[capacity]):
            items, room = [int(lengths[j])], capacity - int(lengths[j])
            while room > 0:
                items.append(int(taken[room]))
                room -= items[-1] or 1
            fresh.add(tuple(sorted((x for x in items if x), reverse=True)))
        full = full or max(map(sum, fresh))
        fresh = [items for items in fresh if sum(items) >= full]
        if not fresh:
            break
        for items in sorted(fresh, reverse=True):
            own, times = np.unique(items, return_counts=True)
            amount = (np.minimum(step * need[own], need[own] - covered[own]) / times).min()
            if amount > 0:
                covered[own] += amount * times
                amounts[items] = amounts.get(items, 0.0) + amount
    return amounts


def best_fit(counts: np.ndarray, capacity: int) -> Patterns:
    """Best fit, the longest pieces first; all sequences with the same content are one group."""
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in range(capacity, 0, -1):
        n = int(counts[length])
        while n:
            room = min((r for r in rooms if r >= length), default=None)
            if room is None:
                items, copies, room = (), n, capacity
            else:
                items, copies = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
            most = room // length
            used, each = (min(copies, n // most), most) if n >= most else (1, n)
            n -= used * each
            rooms.setdefault(room - each * length, []).append((items + (length,) * each, used))
            if items and copies > used:
                rooms.setdefault(room, []).append((items, copies - used))
    return [group for groups in rooms.values() for group in groups]


def fill(counts: np.ndarray, capacity: int) -> Patterns:
    """The largest piece left and, of the others, what fills its sequence furthest, longer pieces first."""
    left = {int(x): int(counts[x]) for x in np.flatnonzero(counts)}
    found: Counter[tuple[int, ...]] = Counter()

    def take(length: int, n: int) -> None:
        left[length] -= n
        if not left[length]:
            del left[length]

    while left:
        items = [max(left)]
        take(items[0], 1)
        room = capacity - items[0]
        sums, mask, trail = 1, (1 << room + 1) - 1, []  # bit k: k tokens can be reached
        for length in sorted((x for x in left if x <= room), reverse=True):
            n, part = min(left[length], room // length), 1
            while n:  # 1, 2, 4 ... copies at a time
                part = min(part, n)
                trail.append((sums, length, part))
                sums |= sums << length * part & mask
                n, part = n - part, part * 2
            if sums >> room & 1:
                break
        reached = sums.bit_length() - 1
        for before, length, part in reversed(trail):
            if not before >> reached & 1:
                reached -= length * part
                items += [length] * part
                take(length, part)
        found[tuple(items)] += 1
    return list(found.items())


def configurations(counts: np.ndarray, capacity: int = CAPACITY) -> Patterns:
    """``(lengths, copies)`` that hold ``counts[length]`` pieces of every length exactly.

    Solutions are rounded down to whole copies until few pieces are left or a
    solution places hardly any of them; the remainder takes the better of best
    fit and filling.
    """
    return min((_rounded(counts, capacity, s) for s in SETTINGS), key=lambda found: sum(c for _, c in found))


def _rounded(counts: np.ndarray, capacity: int, setting: tuple[float, float, float]) -> Patterns:
    left = np.asarray(counts, np.int64).copy()
    patterns: Counter[tuple[int, ...]] = Counter()
    if left[capacity]:
        patterns[(capacity,)] = int(left[capacity])
        left[capacity] = 0
    while (total := int(left.sum())) > FEW:
        for items, amount in solve(left, capacity, setting).items():
            if copies := int(amount):
                own, times = np.unique(items, return_counts=True)
                left[own] -= copies * times
                patterns[items] += copies
        if left.sum() > STALL * total:
            break
    rests = [best_fit(left, capacity)]
    if left.sum() <= 10 * FEW:
        rests.append(fill(left, capacity))
    for items, copies in min(rests, key=lambda rest: sum(c for _, c in rest)):
        patterns[items] += copies
    return list(patterns.items())


# ------------------------------------------------------------------------- tokens


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level BPE file of ``tokenizers``; its special tokens are left out."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    special = {t["content"] for t in spec["added_tokens"]}
    return {bytes(byte[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = 2, ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of the pieces of every document, with ``ids`` also ``ids``.

    The ids of a text by the vocabulary of ``path``, then ``end``. A longer
    document is cut from its end into pieces of ``capacity``, so the first may
    be shorter. The merges of a byte-level BPE file are in the order of its ids,
    so ids as ranks give the same tokens; the strings of special tokens are
    ordinary text. NULL and empty texts have one piece with ``end`` alone;
    repeated rows give repeated pieces.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding("bpe", pat_str=WORDS, mergeable_ranks=ranks.value, special_tokens={})
        for got in batches:
            rows, volume = [], 0
            for doc_id, text in zip(got.column(0).to_pylist(), got.column(1), strict=True):
                tokens = np.append(encoding.encode_to_numpy(text.as_py() or ""), np.uint32(end)).astype("<u4")
                first = len(tokens) % capacity or capacity
                bounds = [0, *range(first, len(tokens) + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    part = tokens[a:b]
                    row = (doc_id, k, a, b - a, zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype(np.int32)) if ids else row)
                volume += len(tokens)
                if volume > TOKENS:
                    yield batch(schema, *zip(*rows, strict=True))
                    rows, volume = [], 0
            if rows:
                yield batch(schema, *zip(*rows, strict=True))

    columns = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * ids
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, columns)


# -------------------------------------------------------------------------- places


def _slots(patterns: Patterns) -> tuple[np.ndarray, ...]:
    """Per stretch of places for one length: ``length, first, times, sequence, offset``, by length and first."""
    rows, sequence, used = [], 0, Counter()
    for items, copies in patterns:
        offset = 0
        for length, times in Counter(items).items():
            rows.append((length, used[length], times, sequence, offset))
            used[length] += times * copies
            offset += times * length
        sequence += copies
    table = np.array(rows, np.int64).reshape(-1, 5)
    return tuple(table[np.lexsort((table[:, 1], table[:, 0]))].T)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: sequences of at most ``capacity``, filled without gaps.

    ``pieces`` has a column ``length`` from 1 to ``capacity``, other columns are
    carried. It is written once; its pieces are numbered by length, inside the
    written parts and then over these, so a length that most pieces have is
    numbered by many tasks. The driver sees one count a length. An empty table
    gives an empty result.
    """
    kept = durable(pieces)
    rows = kept.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    counts = durable(rows.groupBy("length", "_part").agg(F.count("*").alias("_n")))
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect():
        histogram[r.length] = r.n
    slots = _slots(configurations(histogram, capacity))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy("length", "_part").orderBy("_row")) - 1
    rows = rows.withColumn("_number", number).join(offsets, ["length", "_part"])
    rows = rows.select(*pieces.columns, (F.col("_number") + F.col("_before")).alias("_number"))
    shared = rows.sparkSession.sparkContext.broadcast(slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, first, times, sequence, offset = shared.value
        starts = np.searchsorted(lengths, np.arange(capacity + 2))
        for got in batches:
            length, place = got.column("length").to_numpy(), got.column("_number").to_numpy()
            at = np.empty(len(place), np.int64)
            for x in np.unique(length):
                own = length == x
                a, b = starts[x], starts[x + 1]
                at[own] = a + np.searchsorted(first[a:b], place[own], side="right") - 1
            copy, within = np.divmod(place - first[at], times[at])
            names = [*got.schema.names[:-1], "sequence_id", "offset"]
            columns = [*got.columns[:-1], pa.array(sequence[at] + copy), pa.array(offset[at] + within * length)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema]
    return rows.mapInArrow(run, ", ".join([*fields, "sequence_id bigint", "offset bigint"]))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = 2, ids: bool = False) -> DataFrame:
    """The pieces of ``docs``, see ``token_pieces``, with their sequences, see ``pack``."""
    return pack(token_pieces(docs, path, capacity, end, ids), capacity)
