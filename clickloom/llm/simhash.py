"""SimHash near-duplicates by anchor-point covering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ASCII_LOWER, batch, by_row, durable
from clickloom.llm.graph import connected_components

#: Fingerprints that are compared with each other in one tile of a cell.
TILE = 50_000
#: Rows and pairs that a task holds at a time while it compares small cells.
CHUNK = 200_000
PAIRS = 4_000_000


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, width: int = 4) -> int:
    """64 bits; a bit is 1 where over half of the shingle hashes have it.

    Shingles are ``width`` consecutive words, repeats included; a text of fewer
    words is one shingle; a text without words, NULL included, gives 0.
    """
    words = (text or "").encode().translate(ASCII_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    if len(words) > width:
        first, last = starts[: 1 - width].tolist(), ends[width - 1 :].tolist()
    else:
        first, last = [0], [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], 42) for s, e in zip(first, last, strict=True)), np.uint64, len(first))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed long) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def row(doc_id, text):
        bits = fingerprint(text, width)
        return doc_id, bits - (1 << 64) if bits >> 63 else bits

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(by_row(row, schema), "doc_id bigint, fp bigint")


# --------------------------------------------------------------------- anchors


class Covering:
    """A covering code on a block of bits: Hamming [15, 11] beside free bits.

    The Hamming code is perfect: each word of 15 bits has one code word within
    one bit. The code on the block has covering radius 1, and the anchors
    within 2 bits of a word are found from its syndrome by a small table.
    """

    RADIUS, REACH = 1, 2

    def __init__(self, width: int):
        if width < 15:
            raise ValueError("a block needs 15 bits")
        self.width = width
        single = [(i + 1 if i < 15 else 0, 1 << i) for i in range(width)]
        table: list[list[int]] = [[] for _ in range(16)]
        table[0].append(0)
        for k, (s, e) in enumerate(single):
            table[s].append(e)
            for s2, e2 in single[:k]:
                table[s ^ s2].append(e | e2)
        self.near = [np.array(sorted(t, key=lambda e: (e.bit_count(), e)), np.uint64) for t in table]

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.uint64)
        for i in range(15):
            out ^= ((words >> np.uint64(i)) & np.uint64(1)) * np.uint64(i + 1)
        return out

    def anchors(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows, their anchors within radius and threshold, and which is the home."""
        syndromes = self.syndrome(words)
        for s in range(16):
            rows = np.flatnonzero(syndromes == s)
            if len(rows):
                near = self.near[s]
                at = (words[rows][:, None] ^ near[None, :]).ravel()
                home = np.tile(np.arange(len(near)) == 0, len(rows))
                yield np.repeat(rows, len(near)), at, home


def blocks(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of blocks such that two words within ``distance`` bits are within 1 in some block."""
    n = distance // 2 + 1
    if 64 // n < 15:
        raise ValueError("at most 7 bits")
    edges = [64 * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _cells(distance: int, homes_only: bool = False):
    """Rows (cell, fp, home) of each fingerprint at each of its anchors, or at its homes."""
    schema = pa.schema([("cell", pa.int64()), ("fp", pa.int64()), ("home", pa.bool_())])

    def run(batches):
        codes = [(k, a, w, Covering(w)) for k, (a, w) in enumerate(blocks(distance))]
        for got in batches:
            whole = got.column(0).to_numpy(zero_copy_only=False)
            for start in range(0, len(whole), 10_000):
                fps = whole[start : start + 10_000].astype(np.int64)
                bits = fps.view(np.uint64)
                for k, first, width, code in codes:
                    mask = np.uint64((1 << width) - 1) if width < 64 else np.uint64(2**64 - 1)
                    words = (bits >> np.uint64(first)) & mask
                    for rows, anchor, home in code.anchors(words):
                        # a block of up to 58 bits leaves room for its number
                        cell = (anchor * np.uint64(8) + np.uint64(k)).view(np.int64)
                        if homes_only:
                            rows, cell, home = rows[home], cell[home], home[home]
                        yield batch(schema, pa.array(cell), pa.array(fps[rows]), pa.array(home))

    return run


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each of ``n`` nodes' component, by label spreading and jumping."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        if (label == before).all():
            break
        keep = label[a] != label[b]
        a, b = a[keep], b[keep]
    return label


def _links_small(cell: np.ndarray, fp: np.ndarray, home: np.ndarray, distance: int):
    """Links among the rows of whole cells, as stars over the distinct fingerprints."""
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    sizes = np.diff(np.r_[starts, len(cell)])
    start_of, size_of = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    homes = np.flatnonzero(home & (size_of > 1))
    left, right = [], []
    counts = size_of[homes]
    cuts = np.searchsorted(np.cumsum(counts), np.arange(PAIRS, counts.sum() + PAIRS, PAIRS), side="right")
    at = 0
    for cut in [*cuts.tolist(), len(homes)]:
        own = homes[at:cut] if cut > at else homes[at : at + 1] if at < len(homes) else homes[:0]
        at += len(own)
        if not len(own):
            continue
        n = size_of[own]
        i = np.repeat(own, n)
        j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start_of[own], n)
        hit = (np.bitwise_count(fp[i] ^ fp[j]) <= distance) & (fp[i] != fp[j])
        left.append(fp[i[hit]])
        right.append(fp[j[hit]])
    if not left:
        return fp[:0], fp[:0]
    ends = np.concatenate(left), np.concatenate(right)
    nodes, index = np.unique(np.concatenate(ends), return_inverse=True)
    label = _roots(len(nodes), index[: len(ends[0])], index[len(ends[0]) :])
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


class LargeCell:
    """Links of a cell too large for all its pairs at once.

    Homes are compared with every row that is not linked to them yet. In a
    dense group the first few homes link almost all rows, and the rest have
    little left to compare; no pair in different parts stays uncompared.
    """

    def __init__(self, distance: int):
        self.distance = distance

    def links(self, fp: np.ndarray, home: np.ndarray):
        fp, index = np.unique(fp, return_inverse=True)
        homes = np.unique(index[home])
        label = np.arange(len(fp))
        a, b = [], []
        giant, outside = -1, np.arange(0)
        for i in homes.tolist():
            own = label[i]
            rest = outside if own == giant else np.flatnonzero(label != own)
            near = rest[np.bitwise_count(fp[rest] ^ fp[i]) <= self.distance] if len(rest) else rest
            if len(near):
                old, first = np.unique(label[near], return_index=True)
                a.append(fp[near[first]])
                b.append(np.full(len(old), fp[i]))
                label[np.isin(label, old)] = own
            if len(near) or giant < 0:
                giant = np.bincount(label, minlength=1).argmax()
                outside = np.flatnonzero(label != giant)
        if not a:
            return fp[:0], fp[:0]
        return np.concatenate(a), np.concatenate(b)


def _links(distance: int):
    """Links of the cells of a partition whose rows come sorted by cell."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    large = LargeCell(distance)

    def out(pair):
        return batch(schema, pa.array(pair[0].view(np.int64)), pa.array(pair[1].view(np.int64)))

    def done(cell, fp, home):
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.arange(0)
        sizes = np.diff(np.r_[starts, len(cell)])
        small = np.ones(len(cell), bool)
        for s, n in zip(starts[sizes > 2000].tolist(), sizes[sizes > 2000].tolist(), strict=True):
            small[s : s + n] = False
            if home[s : s + n].any():
                yield out(large.links(fp[s : s + n], home[s : s + n]))
        if small.any():
            yield out(_links_small(cell[small], fp[small], home[small], distance))

    def run(batches):
        held: list[tuple] = []
        rows = 0
        for got in batches:
            held.append(
                (got.column(0).to_numpy(), got.column(1).to_numpy().view(np.uint64), got.column(2).to_numpy(zero_copy_only=False))
            )
            rows += got.num_rows
            if rows >= CHUNK:
                cell, fp, home = (np.concatenate(c) for c in zip(*held, strict=True))
                cut = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on in the next batch
                if cut:
                    yield from done(cell[:cut], fp[:cut], home[:cut])
                held, rows = [(cell[cut:], fp[cut:], home[cut:])], 0
        if held:
            yield from done(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return run


def fingerprint_links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """``(a, b)`` rows that connect all distinct ``fp`` within ``distance`` bits of each other.

    Anchor-point covering: the 64 bits are cut in ``distance // 2 + 1`` blocks,
    so two fingerprints within ``distance`` differ by at most one bit in some
    block. On each block the code words of a covering code are the anchors. A
    fingerprint is at home at its nearest anchor (covering radius 1) and goes
    to all anchors within radius plus threshold, 2 bits; whatever is within one
    bit of it in the block is at home at one of these. Homes are compared with
    all rows of their anchor. The rows returned are spanning stars, not all
    pairs. An anchor with more than ``TILE`` homes is dealt over several
    tasks by a hash of the home; the others are sent to each of them.
    """
    distinct = prints.select("fp").distinct()
    kind = "cell bigint, fp bigint, home boolean"
    hot = distinct.mapInArrow(_cells(distance, homes_only=True), kind).groupBy("cell").count()
    hot = hot.where(F.col("count") > TILE).select(
        F.col("cell").alias("hot_cell"), F.ceil(F.col("count") / TILE).cast("int").alias("tiles")
    )
    cells = distinct.mapInArrow(_cells(distance), kind)
    tiles = F.coalesce("tiles", F.lit(1))
    dealt = (
        cells.join(hot, F.col("cell") == F.col("hot_cell"), "left")
        .withColumn("tile", F.explode(F.sequence(F.lit(0), tiles - 1)))
        .select(
            F.when(F.col("tile") == 0, F.col("cell")).otherwise(F.xxhash64("cell", "tile")).alias("part"),
            "fp",
            (F.col("home") & (F.col("tile") == F.pmod(F.xxhash64("fp"), tiles))).alias("home"),
        )
    )
    dealt = dealt.repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(_links(distance), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``.

    Fingerprints within ``distance`` bits are linked; ``component_id`` is the
    smallest ``doc_id`` reachable, the row's own included. Texts without words,
    NULL and empty ones, have fingerprint zero and are linked like any other.
    Rows with a NULL ``doc_id`` take part and never name a component; a
    component of only such rows has a NULL id. Repeated rows give repeated
    results. Extra columns are not read. An empty table gives an empty result.
    """
    rows = durable(fingerprints(docs, width))
    return _label(rows, distance)


def _label(rows: DataFrame, distance: int) -> DataFrame:
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(fingerprint_links(rows, distance))
    firsts = firsts.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = firsts.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = firsts.join(least, "root").select(F.col("fp").alias("print"), "root", "component_id")
    return rows.join(by_print, F.col("fp") == F.col("print")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("root"),
    )


def drop_near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``, all columns kept.

    The row with the smallest ``doc_id`` stays (NULL last), of equal ids the one
    with the least text hash; of rows that repeat each other one stays.
    """
    own = F.xxhash64(F.col("text").cast("string"))
    keyed = docs.withColumn("_text_key", own)
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("fp", pa.int64())])

    def row(doc_id, text, key):
        bits = fingerprint(text, width)
        return doc_id, key, bits - (1 << 64) if bits >> 63 else bits

    rows = keyed.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), "_text_key")
    rows = durable(rows.mapInArrow(by_row(row, schema), "doc_id bigint, key bigint, fp bigint"))
    roots = connected_components(fingerprint_links(rows, distance))
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key")
    # first per fingerprint, then per component: the large groups are reduced before they meet
    firsts = rows.groupBy("fp").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    firsts = firsts.join(roots, F.col("fp") == F.col("node"), "left")
    stays = firsts.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    stays = stays.select(F.col("first.doc_id").alias("_stay_id"), F.col("first.key").alias("_stay_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_stay_id")) & (F.col("_text_key") == F.col("_stay_key"))
    kept = keyed.join(stays, same, "left_semi")
    repeated = rows.groupBy("doc_id", "key").count().where("count > 1").limit(1)
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    return kept.dropDuplicates(["doc_id", "_text_key"]).select(*docs.columns)
