"""Fuzzy line dedup: MinHash signatures, banding, exact Jaccard, union-find."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import batch, durable
from clickloom.llm.graph import connected_components

#: Characters of a shingle. A power of two, for the rolling hash.
SHINGLE = 8
#: Least Jaccard similarity of two lines that count as the same.
SIMILARITY = 0.8
#: Bands and rows: a pair at 0.8 meets in a band with 99.6 %, one at 0.85 with 99.97 %.
BANDS, ROWS = 14, 5
#: Lines and characters of a candidate group that one task holds at a time.
TILE, TILE_CHARS = 20_000, 8_000_000
#: Groups of so many lines are compared pair by pair.
FEW = 24
#: Code points that one signature step handles at a time; its arrays fit the processor's cache.
STEP = 500_000


def normal_line(line: Column) -> Column:
    """The form in which lines are compared: trimmed, in lower case.

    Trimming walks through all of a line's characters, so only lines that
    begin or end with a blank are trimmed.
    """
    blanks = " \t\r\x0b\x0c"
    outer = [test(line, F.lit(c)) for c in blanks for test in (F.startswith, F.endswith)]
    return F.lower(F.when(reduce(or_, outer), F.btrim(line, F.lit(blanks))).otherwise(line))


def lines(docs: DataFrame) -> DataFrame:
    """``doc_id, doc_key, line_no, line`` of every line with content, in compared form.

    ``doc_key`` is a hash of the text; with ``doc_id`` it names a row.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("doc_key"), F.posexplode(F.split("text", "\n")))
    rows = rows.select("doc_id", "doc_key", F.col("pos").alias("line_no"), normal_line(F.col("col")).alias("line"))
    return rows.where("line <> ''")


# ------------------------------------------------------------------ signatures


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place."""
    for multiplier in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x ^= x >> np.uint64(33)
        x *= np.uint64(multiplier)
    x ^= x >> np.uint64(33)
    return x


def shingle_hashes(points: np.ndarray) -> np.ndarray:
    """A hash of the ``SHINGLE`` code points from each place on, by doubling."""
    h = points.astype(np.uint64) + np.uint64(1)
    power, width = 0x9E3779B97F4A7C15, 1
    while width < SHINGLE:
        h = h[:-width] * np.uint64(power) + h[width:]
        power = power * power % (1 << 64)
        width *= 2
    return _mixed(h)


def _short_hashes(points: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the ``SHINGLE`` code points from each place on, for signatures."""
    h, power, width = points, 0x9E3779B1, 1
    while width < SHINGLE:
        h = h[:-width] * np.uint32(power) + h[width:]
        power = power * power % (1 << 32)
        width *= 2
    moved = np.empty_like(h)
    for shift, multiplier in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        np.right_shift(h, np.uint32(shift), out=moved)
        h ^= moved
        h *= np.uint32(multiplier)
    return h


def _filled(least: np.ndarray, empty: int) -> np.ndarray:
    """``least`` with the value of the next filled bin, changed by the distance, in empty ones."""
    bins = least.shape[1]
    here = np.arange(bins)
    at = np.where(least != empty, here, 2 * bins)
    first = at.min(axis=1, keepdims=True)
    after = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1]
    after = np.where(after == 2 * bins, first + bins, after)
    value = np.take_along_axis(least, after % bins, axis=1)
    return value + (after - here).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def band_keys(texts: list[str]) -> np.ndarray:
    """A row of ``BANDS`` 64-bit keys for each line.

    One-permutation MinHash: a shingle's hash chooses one of ``BANDS * ROWS``
    bins and competes for the minimum there; an empty bin takes the value of
    the next one that is filled, changed by the distance. A line of fewer
    characters than a shingle is padded to one. Equal hashes of different
    shingles only add candidates, which are compared exactly.
    """
    bins, count = BANDS * ROWS, len(texts)
    joined = "".join(t if len(t) >= SHINGLE else t.ljust(SHINGLE, "\0") for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    sizes = np.fromiter((max(len(t), SHINGLE) for t in texts), np.int64, count)
    hashes = _short_hashes(points)
    place = np.repeat(np.arange(count) * bins, sizes)[: len(hashes)]
    chosen = hashes >> np.uint32(16)
    chosen *= np.uint32(bins)
    chosen >>= np.uint32(16)
    place += chosen
    # a shingle that reaches into the next line goes to a bin of its own
    across = np.cumsum(sizes)[:-1, None] - np.arange(1, SHINGLE)
    place[across] = count * bins
    empty = (1 << 32) - 1
    least = np.full(count * bins + 1, empty, np.uint32)
    np.minimum.at(least, place, hashes)
    least = _filled(least[:-1].reshape(count, bins).astype(np.uint64), empty)
    keys = np.zeros((count, BANDS), np.uint64)
    for r in range(ROWS):
        keys = keys * np.uint64(0x100000001B3) + least[:, r::ROWS]
    return _mixed(keys + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(band, line_key)`` of each line; a line that a task has seen lately is left out."""
    schema = pa.schema([("band", pa.int64()), ("line_key", pa.int64())])
    seen: set[int] = set()
    for got in batches:
        keys, texts = got.column(0).to_pylist(), got.column(1).to_pylist()
        fresh = [k for k, key in enumerate(keys) if key not in seen and not seen.add(key)]
        if len(seen) > 1_000_000:
            seen.clear()
        at = 0
        while at < len(fresh):
            start, volume = at, 0
            while at < len(fresh) and (volume < STEP or at == start):
                volume += len(texts[fresh[at]])
                at += 1
            part = fresh[start:at]
            bands = band_keys([texts[k] for k in part]).view(np.int64)
            own = np.repeat(np.fromiter((keys[k] for k in part), np.int64, len(part)), BANDS)
            yield batch(schema, pa.array(bands.ravel()), pa.array(own))


def _led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(leader, line_key)`` of rows (band, line_key) sorted in that order; only the bucket's leader is held."""
    schema = pa.schema([("leader", pa.int64()), ("line_key", pa.int64())])
    last = None  # band and leader of the row before
    for got in batches:
        if not got.num_rows:
            continue
        band, key = (c.to_numpy() for c in got.columns)
        starts = np.flatnonzero(np.concatenate(([True], band[1:] != band[:-1])))
        least = key[starts]
        if last is not None and last[0] == band[0]:
            least[0] = last[1]
        leader = np.repeat(least, np.diff(starts, append=len(band)))
        last = band[-1], leader[-1]
        others = leader != key
        others[1:] &= (band[1:] != band[:-1]) | (key[1:] != key[:-1])
        led = np.unique(leader[others])
        leaders, keys = np.concatenate((leader[others], led)), np.concatenate((key[others], led))
        yield batch(schema, pa.array(leaders), pa.array(keys))


def candidate_groups(rows: DataFrame) -> DataFrame:
    """``(leader, line_key)``: lines that share a band with their group's least line, the leader included.

    All lines of a bucket get the same leader, so two lines that share any
    bucket share a group; buckets of one line give no rows. A cluster that
    meets in most of its bands is one group, not one for each band. Buckets
    pass by in order of band and line, so none of them is held.
    """
    bands = rows.select("line_key", "line").mapInArrow(_band_rows, "band bigint, line_key bigint")
    bands = bands.repartition("band").sortWithinPartitions("band", "line_key")
    return bands.mapInArrow(_led, "leader bigint, line_key bigint").distinct()


# ---------------------------------------------------------------- verification


def shingles(line: str) -> frozenset[str]:
    if len(line) < SHINGLE:
        return frozenset((line,))
    return frozenset(line[k : k + SHINGLE] for k in range(len(line) - SHINGLE + 1))


def similar(a: frozenset[str], b: frozenset[str], least: float = SIMILARITY) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if len(small) < least * len(large):
        return False
    both = len(small & large)
    return both >= least * (len(a) + len(b) - both)


def shingle_codes(line: str) -> tuple[np.ndarray, bool]:
    """Sorted distinct codes of a line's shingles, and whether they tell shingles apart for certain.

    Eight characters below 256 are their eight bytes, any other shingle is a
    64-bit hash. Lines of fewer characters than a shingle are padded.
    """
    padded = line.ljust(SHINGLE, "\0")
    try:
        narrow, plain = padded.encode("latin-1"), True
    except UnicodeEncodeError:
        narrow, plain = padded.encode("latin-1", "replace"), False
    # the number at every byte, in place of shifts and sums
    codes = np.ndarray((len(padded) - SHINGLE + 1,), "<u8", narrow, strides=(1,)).copy()
    if not plain:
        points = np.frombuffer(padded.encode("utf-32-le"), np.uint32)
        wide = np.convolve(points > 255, np.ones(SHINGLE, np.int64), "valid") > 0
        codes[wide] = shingle_hashes(points)[wide]
    codes.sort()
    fresh = np.empty(len(codes), bool)
    fresh[0] = True
    np.not_equal(codes[1:], codes[:-1], out=fresh[1:])
    return codes[fresh], plain and len(line) >= SHINGLE


def similar_codes(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """``similar`` of two sets of codes."""
    small, large = sorted((len(a), len(b)))
    if small < least * large:
        return False
    both = np.concatenate((a, b))
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared >= least * (small + large - shared)


class Lines:
    """Lines that are compared exactly: by their codes and, where a code may be a hash, by their text."""

    def __init__(self, lines: list[str], least: float):
        self.lines, self.least = lines, least
        self.codes = [shingle_codes(x) for x in lines]

    def similar(self, line: str, own: tuple[np.ndarray, bool], k: int) -> bool:
        """Whether a line with the codes ``own`` is similar to line ``k``."""
        if not similar_codes(own[0], self.codes[k][0], self.least):
            return False
        if own[1] and self.codes[k][1]:
            return True
        return similar(shingles(line), shingles(self.lines[k]), self.least)


def few_links(lines: list[str], least: float) -> list[tuple[int, int]]:
    """Links among a few lines, each pair compared that is not linked already."""
    sets, label, links = Lines(lines, least), list(range(len(lines))), []
    for i in range(len(lines)):
        for j in range(i):
            if label[i] != label[j] and sets.similar(lines[i], sets.codes[i], j):
                links.append((i, j))
                label = [label[j] if x == label[i] else x for x in label]
    return links


class Group:
    """Links of one tile of a candidate group by exact comparison.

    Residents are held, guests pass by. The rarest shingles of a line come
    first; two lines that are similar enough share one of their first ones, so
    only lines that do are compared (an exact filter). Lines that are linked
    already are not compared: in a tight group a line meets a few members of
    its largest part, and then only what lies outside of that part.
    """

    SAMPLE = 8

    def __init__(self, keys: list[int], lines: list[str], least: float):
        self.least, self.keys = least, keys
        self.held = Lines(lines, least)
        values, counts = np.unique(np.concatenate([c for c, _ in self.held.codes]), return_counts=True)
        self.values, self.counts = values, counts
        self.parent = list(range(len(keys)))
        self.size = [1] * len(keys)
        self.large = -1  # a member of the large part, once there is one
        self.sample: list[int] = []
        self.inner: dict[int, list[int]] = {}  # first shingles of members of the large part
        self.outer: dict[int, list[int]] = {}  # and of the others, as they were when they came

    def _first(self, own: np.ndarray) -> list[int]:
        at = np.searchsorted(self.values, own)
        known = at < len(self.values)
        known[known] = self.values[at[known]] == own[known]
        rarity = np.zeros(len(own), np.int64)
        rarity[known] = self.counts[at[known]]
        order = np.lexsort((own, rarity))
        return own[order[: len(own) - math.ceil(self.least * len(own) - 1e-9) + 1]].tolist()

    def _find(self, k: int) -> int:
        parent = self.parent
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    def _links(self, line: str, own: tuple[np.ndarray, bool], first: list[int]) -> list[int]:
        """One similar resident of each part that has any."""
        found: dict[int, int] = {}
        top = self._find(self.large) if self.large >= 0 else -1
        for k in self.sample:
            if self.held.similar(line, own, k):
                found[top] = k
                break
        tried: set[int] = set()
        for index in (self.outer,) if top in found else (self.outer, self.inner):
            for shingle in first:
                for k in index.get(shingle, ()):
                    if k in tried:
                        continue
                    tried.add(k)
                    part = self._find(k)
                    if part not in found and self.held.similar(line, own, k):
                        found[part] = k
                if index is self.inner and top in found:
                    break
        return list(found.values())

    def settle(self) -> list[tuple[int, int]]:
        """Links among the residents."""
        links = []
        for k, (line, own) in enumerate(zip(self.held.lines, self.held.codes, strict=True)):
            first = self._first(own[0])
            for other in self._links(line, own, first):
                links.append((self.keys[k], self.keys[other]))
                a, b = self._find(k), self._find(other)
                self.parent[a] = b
                self.size[b] += self.size[a]
                if self.large < 0 and self.size[b] >= self.SAMPLE:
                    self.large = b
                    self.sample = [j for j in range(k + 1) if self._find(j) == b][: self.SAMPLE]
            index = self.inner if self.large >= 0 and self._find(k) == self._find(self.large) else self.outer
            for shingle in first:
                index.setdefault(shingle, []).append(k)
        return links

    def visit(self, key: int, line: str) -> list[tuple[int, int]]:
        """Links of a guest to the residents."""
        own = shingle_codes(line)
        return [(key, self.keys[k]) for k in self._links(line, own, self._first(own[0]))]


def _verified(least: float):
    """``(a, b)`` links of rows (leader, tile, guest, line_key, line) sorted in that order."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        at, keys, lines, group = None, [], [], None

        def ended():
            """Links of a group without guests."""
            if len(keys) > FEW:
                return Group(keys, lines, least).settle()
            return [(keys[i], keys[j]) for i, j in few_links(lines, least)]

        for got in batches:
            links: list[tuple[int, int]] = []
            for leader, tile, guest, key, line in zip(*(c.to_pylist() for c in got.columns), strict=True):
                if at != (leader, tile):
                    if group is None and at is not None:
                        links += ended()
                    at, keys, lines, group = (leader, tile), [], [], None
                if not guest:
                    keys.append(key)
                    lines.append(line)
                elif keys:
                    if group is None:
                        group = Group(keys, lines, least)
                        links += group.settle()
                    links += group.visit(key, line)
            if links:
                yield batch(schema, *zip(*links, strict=True))
        if group is None and at is not None and (links := ended()):
            yield batch(schema, *zip(*links, strict=True))

    return run


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(line_key, raw)`` of the wanted lines of texts."""
    schema = pa.schema([("line_key", pa.int64()), ("raw", pa.string())])
    for got in batches:
        for start in range(0, got.num_rows, 500):
            part, picked = got.slice(start, 500), []
            for text, wanted in zip(part.column(0), part.column(1), strict=True):
                own = text.as_py().split("\n")
                picked += [(w["line_key"], own[w["line_no"]]) for w in wanted.as_py()]
            yield batch(schema, *zip(*picked, strict=True))


def line_texts(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """``line_key, line`` of ``firsts(line_key, first)``, read from the document that ``first`` names.

    Each line is wanted of one document, so a line that very many documents
    hold is fetched once; documents without wanted lines leave the join.
    """
    wanted = firsts.groupBy("first.doc_id", "first.doc_key").agg(
        F.collect_list(F.struct(F.col("first.line_no").alias("line_no"), "line_key")).alias("wanted")
    )
    rows = docs.select(F.col("doc_id").cast("bigint").alias("own_id"), F.col("text").cast("string").alias("text"))
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64("text") == F.col("doc_key"))
    picked = rows.join(wanted, same).select("text", "wanted").mapInArrow(_picked, "line_key bigint, raw string")
    # only a repeated document gives a line again
    return picked.select("line_key", normal_line(F.col("raw")).alias("line")).dropDuplicates(["line_key"])


def similar_lines(docs: DataFrame, rows: DataFrame, firsts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``(a, b)`` links between line keys at a Jaccard similarity of ``least`` or more.

    ``rows(line_key, line)`` are the lines of ``docs``, ``firsts(line_key,
    first, size)`` one place and the characters of each. A candidate group of more than ``TILE`` lines or
    ``TILE_CHARS`` characters is cut in tiles by a hash: the lines of a tile
    stay there as residents and visit the tiles before as guests.
    """
    members = durable(candidate_groups(rows))
    wanted = members.select(F.col("line_key").alias("member")).distinct()
    places = firsts.join(wanted, F.col("line_key") == F.col("member"), "left_semi")
    sizes = places.select(F.col("line_key").alias("sized"), "size")
    tiles = F.ceil(F.greatest(F.count("*") / TILE, F.sum("size") / TILE_CHARS)).cast("int")
    large = members.join(sizes, F.col("line_key") == F.col("sized")).groupBy("leader").agg(tiles.alias("tiles")).where("tiles > 1")
    large = large.select(F.col("leader").alias("large"), "tiles")
    own = F.pmod(F.xxhash64("line_key"), F.coalesce("tiles", F.lit(1))).cast("int")
    placed = members.join(large, F.col("leader") == F.col("large"), "left").withColumn("own", own)
    placed = placed.select(
        "leader", F.explode(F.sequence(F.lit(0), "own")).alias("tile"), "own", F.col("line_key").alias("member")
    )
    texts = line_texts(docs, places)
    full = placed.join(texts, F.col("member") == F.col("line_key")).select(
        "leader", "tile", (F.col("tile") != F.col("own")).alias("guest"), "line_key", "line"
    )
    full = full.repartition("leader", "tile").sortWithinPartitions("leader", "tile", "guest", "line_key")
    return full.mapInArrow(_verified(least), "a bigint, b bigint")


# ----------------------------------------------------------------------- dedup


def duplicate_lines(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row for each line with content of each document.

    Columns: ``doc_id, doc_key, line_no`` (from 0), ``component_id`` (the
    component's least line key), ``kept_doc_id, kept_line_no`` (the line that
    stays) and ``kept``. Equal lines, and lines whose sets of eight-character
    shingles have a Jaccard similarity of ``least`` or more, are linked; one
    line of each component stays: that of the smallest ``doc_id`` (NULL last),
    then text hash, then line number. Blank lines are no lines: they have no
    row and are never dropped. NULL and empty texts have no rows. Repeated rows
    (equal id and text) share a verdict. Extra columns are not read.
    """
    rows = lines(docs).withColumn("line_key", F.xxhash64("line"))
    size = F.char_length("line").alias("size")
    occurrences = durable(rows.select("doc_id", "doc_key", "line_no", "line_key", size))
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "doc_key", "line_no")
    firsts = occurrences.groupBy("line_key").agg(F.min(place).alias("first"), F.max("size").alias("size"))
    roots = connected_components(similar_lines(docs, rows, firsts, least))
    firsts = firsts.join(roots, F.col("line_key") == F.col("node"), "left").select(
        F.col("line_key").alias("key"), "first", F.coalesce("root", "line_key").alias("component_id")
    )
    kept = firsts.groupBy("component_id").agg(F.min("first").alias("stays"))
    verdict = firsts.join(kept, "component_id").select("key", "component_id", "stays")
    return occurrences.join(verdict, F.col("line_key") == F.col("key")).select(
        "doc_id",
        "doc_key",
        "line_no",
        "component_id",
        F.col("stays.doc_id").alias("kept_doc_id"),
        F.col("stays.line_no").alias("kept_line_no"),
        (place == F.col("stays")).alias("kept"),
    )


def _remaining(texts: pd.Series, gone: pd.Series) -> pd.Series:
    """Texts without the lines of the given numbers; whole where there are none."""

    def rest(text, numbers):
        if text is None or numbers is None:
            return text
        out = set(numbers.tolist())
        return "\n".join(x for k, x in enumerate(text.split("\n")) if k not in out)

    return pd.Series([rest(t, g) for t, g in zip(texts, gone, strict=True)], dtype=object)


def drop_duplicate_lines(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``docs`` without the lines that ``duplicate_lines`` does not keep.

    Every row stays, with all its columns; a text may become empty. ``n_chars``,
    where there is one, follows the new text.
    """
    gone = duplicate_lines(docs, least).where("not kept").select("doc_id", "doc_key", "line_no").distinct()
    gone = gone.groupBy("doc_id", "doc_key").agg(F.collect_list("line_no").alias("_gone"))
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("doc_key").alias("_key"), "_gone")
    own = F.xxhash64(F.col("text").cast("string"))
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (own == F.col("_key")), "left")
    remaining = F.pandas_udf(_remaining, "string")
    out = joined.withColumn("text", remaining(F.col("text").cast("string"), F.col("_gone")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def expected_recall(similarity: float) -> float:
    """The share of pairs at ``similarity`` that meet in a band."""
    return -math.expm1(BANDS * math.log1p(-(similarity**ROWS)))
