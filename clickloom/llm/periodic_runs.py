"""Runs of periodic words by longest common extensions over a difference cover.

The words of many documents stand in one array, each document closed by a word
of its own, so that no extension leaves a document. Only suffixes at places of
a difference cover are sorted. The extension of two places compares a few words
until both places fall on the cover; from there a sparse table of range minima
over the sorted suffixes answers. A harmonic grid of places, spaced by the
period, meets every run of every period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import batch

#: A perfect difference set. Every difference modulo 31 occurs between two of its members.
COVER, CYCLE = (1, 5, 11, 24, 25, 27), 31
#: Words of the documents that are searched together, and grid places that are looked at together.
WORDS, PLACES = 200_000, 2_000_000
#: A run has at least so many words, and so many periods.
LEAST, REPEATS = 6, 4

RUN = "struct<start:bigint,length:bigint,period:bigint>"
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _to_cover() -> np.ndarray:
    """Words from a pair of residues on until both are members of the cover."""
    inside = np.zeros(CYCLE, bool)
    inside[list(COVER)] = True
    a, b, k = np.ogrid[:CYCLE, :CYCLE, :CYCLE]
    return (inside[(a + k) % CYCLE] & inside[(b + k) % CYCLE]).argmax(axis=2)


STEPS = _to_cover()


class Extensions:
    """How far the words from two places on are the same.

    ``words`` are integers from 1 on; the last one occurs once. Every place
    asked for must lie before a word that occurs once.
    """

    def __init__(self, words: np.ndarray) -> None:
        blocks = len(words) // CYCLE + 2
        own = int(words.max(initial=0)) + 1
        self.words = np.concatenate([words, np.arange(own, own + blocks * CYCLE + CYCLE - len(words))])
        self.member = np.zeros(CYCLE, np.int64)
        self.member[list(COVER)] = range(len(COVER))
        places = (np.arange(blocks)[:, None] * CYCLE + np.array(COVER)).ravel()
        levels = [self._first_ranks(places)]
        reach = 1  # cycles that a level compares
        while levels[-1].max() < len(places) - 1:
            now = levels[-1]
            onwards = np.zeros_like(now)
            shift = reach * len(COVER)
            onwards[: max(0, len(now) - shift)] = now[shift:] + 1
            levels.append(np.unique(now * (len(now) + 1) + onwards, return_inverse=True)[1])
            reach *= 2
        self.rank = levels[-1]
        order = np.empty(len(places), np.int64)
        order[self.rank] = np.arange(len(places))
        self.minima = self._sparse(self._neighbours(order, levels, places))

    def _first_ranks(self, places: np.ndarray) -> np.ndarray:
        """Ranks of the sampled suffixes by the words of one cycle."""
        bits = int(self.words[-1]).bit_length()
        each = max(1, 62 // bits)
        keys = []
        for start in range(0, CYCLE, each):
            key = self.words[places + start]
            for k in range(start + 1, min(start + each, CYCLE)):
                key = key << bits | self.words[places + k]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        ranks = np.empty(len(order), np.int64)
        ranks[order] = np.cumsum(new)
        return ranks

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray], places: np.ndarray) -> np.ndarray:
        """Common words of each sorted suffix and the one before it."""
        common = np.zeros(len(order), np.int64)
        a, b = order[:-1].copy(), order[1:].copy()
        for k in range(len(levels) - 1, -1, -1):
            same = np.flatnonzero(levels[k][a] == levels[k][b])
            a[same] += len(COVER) << k
            b[same] += len(COVER) << k
            common[same + 1] += CYCLE << k
        alive = np.arange(len(a))
        for k in range(CYCLE):
            alive = alive[self.words[places[a[alive]] + k] == self.words[places[b[alive]] + k]]
            common[alive + 1] += 1
        return common

    @staticmethod
    def _sparse(values: np.ndarray) -> list[np.ndarray]:
        table, width = [values.astype(np.int32 if len(values) < 2**26 else np.int64)], 1
        while 2 * width <= len(values):
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        steps = STEPS[a % CYCLE, b % CYCLE]
        found = steps.copy()
        alive = np.arange(len(a))
        for k in range(CYCLE):
            alive = alive[steps[alive] > k]
            if not len(alive):
                break
            same = self.words[a[alive] + k] == self.words[b[alive] + k]
            found[alive[~same]] = k
            alive = alive[same]
        rest = np.flatnonzero(found == steps)
        x, y = a[rest] + steps[rest], b[rest] + steps[rest]
        x = self.rank[x // CYCLE * len(COVER) + self.member[x % CYCLE]]
        y = self.rank[y // CYCLE * len(COVER) + self.member[y % CYCLE]]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.minima[k]
            found[rest[at]] += np.minimum(row[low[at]], row[high[at] - (1 << int(k)) + 1])
        return found


def _grid(begins: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``place, period, document``: places two periods apart, for every period that a run of the document can have."""
    periods = np.where(sizes >= LEAST, np.maximum(1, sizes // REPEATS), 0)
    ends = np.cumsum(periods)
    total = int(ends[-1]) if len(ends) else 0
    at = 0
    while at < total:
        # as many (document, period) pairs as PLACES allows, at least one
        pair = np.arange(at, min(total, at + PLACES // 8))
        doc = np.searchsorted(ends, pair, side="right")
        period = pair - (ends[doc] - periods[doc]) + 1
        count = (sizes[doc] - period - 1) // (2 * period) + 1
        fit = max(1, int(np.searchsorted(np.cumsum(count), PLACES, side="right")))
        doc, period, count = doc[:fit], period[:fit], count[:fit]
        at += fit
        total_places = int(count.sum())
        step = np.arange(total_places) - np.repeat(np.cumsum(count) - count, count)
        doc, period = np.repeat(doc, count), np.repeat(period, count)
        yield begins[doc] + 2 * period * step, period, doc


def find_runs(words: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """``document, start, length, period`` of all runs, by document, start and period.

    ``words`` holds the documents, each followed by a word that occurs once.
    """
    same = Extensions(words)
    parts = []
    for place, period, doc in _grid(begins, sizes):
        # a run that no earlier place of the grid lies in goes on for over a period here
        keep = np.flatnonzero(words[place] == words[place + period])
        inside = place[keep] + 2 * period[keep] < begins[doc[keep]] + sizes[doc[keep]]
        keep = keep[inside]
        keep = keep[words[place[keep] + period[keep]] == words[place[keep] + 2 * period[keep]]]
        place, period, doc = place[keep], period[keep], doc[keep]
        ahead = same(place, place + period)
        keep = np.flatnonzero(ahead > np.maximum(period, LEAST - 3 * period))
        place, period, doc, ahead = place[keep], period[keep], doc[keep], ahead[keep]
        # the least start from which the period holds up to the place
        low, high = np.maximum(place - 2 * period, begins[doc]), place.copy()
        while len(at := np.flatnonzero(low < high)):
            middle = (low[at] + high[at]) // 2
            holds = same(middle, middle + period[at]) >= place[at] - middle
            high[at[holds]] = middle[holds]
            low[at[~holds]] = middle[~holds] + 1
        length = place - low + period + ahead
        first = (low > place - 2 * period) & (length >= np.maximum(LEAST, REPEATS * period))
        parts.append(np.stack([doc, low - begins[doc], length, period])[:, first])
    found = np.concatenate(parts, axis=1) if parts else np.zeros((4, 0), np.int64)
    doc, start, length, period = found[:, np.lexsort((found[3], found[2], found[1], found[0]))]
    again = np.zeros(len(doc), bool)  # a multiple of the least period of the same stretch
    again[1:] = (doc[1:] == doc[:-1]) & (start[1:] == start[:-1]) & (length[1:] == length[:-1])
    doc, start, length, period = (x[~again] for x in (doc, start, length, period))
    order = np.lexsort((period, start, doc))
    return doc[order], start[order], length[order], period[order]


def _search(ids: list, texts: list[list[bytes]], schema: pa.Schema) -> pa.RecordBatch:
    index: dict[bytes, int] = {}
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    begins = np.cumsum(sizes + 1) - sizes - 1
    words = np.empty(int(sizes.sum()) + len(texts), np.int64)
    for begin, text in zip(begins, texts, strict=True):
        words[begin : begin + len(text)] = [index.setdefault(w, len(index) + 1) for w in text]
    words[begins + sizes] = np.arange(len(index) + 1, len(index) + 1 + len(texts))
    doc, start, length, period = find_runs(words, begins, sizes)
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(RUN_TYPE))
    kept = []
    for k, text in enumerate(texts):
        mine = slice(bounds[k], bounds[k + 1])
        if mine.start < mine.stop:
            edges = np.zeros(len(text) + 1, np.int64)
            np.add.at(edges, start[mine] + period[mine], 1)
            np.add.at(edges, start[mine] + length[mine], -1)
            text = [text[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
        kept.append(b" ".join(text).decode())
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs)
    return batch(schema, pa.array(ids, pa.int64()), pa.array(sizes), lists, pa.array(kept, pa.large_string()))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN_TYPE)), ("collapsed", pa.large_string())]
    )
    ids, texts, volume = [], [], 0
    for got in batches:
        for doc_id, text in zip(got.column(0).to_pylist(), got.column(1), strict=True):
            words = (text.as_py() or "").encode().split()
            if texts and volume + len(words) > WORDS:
                yield _search(ids, texts, schema)
                ids, texts, volume = [], [], 0
            ids.append(doc_id)
            texts.append(words)
            volume += len(words) + 1
    if texts:
        yield _search(ids, texts, schema)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``docs``.

    Words are stretches without ASCII white space, numbered from 0. A run is a
    stretch of ``max(6, 4 * period)`` words or more with that least period,
    which no neighbouring word extends; ``runs`` has them by start and period.
    ``collapsed`` is the text without the words that a run holds after its
    first period, joined by one space. NULL, empty and blank texts have no
    words, no runs and an empty collapsed text. Repeated rows give repeated
    rows, a NULL id stays NULL, other columns are not read. Memory is bounded
    by the longest document or ``WORDS`` words.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(_documents, f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed string")


def plant_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: every tenth document by checksum of its id ends in a repeated piece of itself.

    With ``h`` the CRC-32 of the id in decimal and ``g = h / 10``, word ``i``
    from ``a = g % n`` on becomes word ``a + (i - a) % p`` with
    ``p = 1 + (n - a) / (3 + g % 8)``, divisions without rest. Other rows and
    those without words or id stay.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).withColumn("_g", F.floor(h / 10))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(0))
    chosen = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    rows = rows.withColumn("_w", F.when(chosen, words))
    rows = rows.withColumn("_a", F.expr("cast(_g % size(_w) as int)"))
    rows = rows.withColumn("_p", F.expr("cast(1 + (size(_w) - _a) div (3 + _g % 8) as int)"))
    again = F.expr("transform(_w, (w, i) -> if(i < _a, w, _w[_a + (i - _a) % _p]))")
    return rows.select("doc_id", F.coalesce(F.array_join(again, " "), "text").alias("text"))


def run_report(docs: DataFrame) -> DataFrame:
    """One row a document: the number of runs, the longest one and digests of all runs and the collapsed text."""
    rows = periodic_runs(docs)
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    # greatest length, then smallest start and period: runs come by start and period
    best = F.expr("get(filter(runs, r -> r.length = array_max(transform(runs, x -> x.length))), 0)")
    rows = rows.withColumn("_best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *(F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
