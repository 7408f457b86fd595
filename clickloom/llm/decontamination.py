"""Benchmark decontamination by Wu-Manber search for windows of words."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import by_row, durable

#: Words of a window.
WINDOW = 10
#: Windows that one search automaton holds; a larger benchmark is searched in blocks.
BLOCK = 500_000
#: Letters and digits stay, A-Z in lower case; bytes of other characters belong to words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


def windows(text: str | None, width: int = WINDOW) -> list[tuple[bytes, ...]]:
    """Windows of ``width`` consecutive words; a shorter text with words is one window."""
    own = tuple(words(text))
    if not own:
        return []
    return [own[k : k + width] for k in range(max(1, len(own) - width + 1))]


class WuManber:
    """Search of word sequences of one length in a word sequence.

    The block is two words. A table gives how far the search may jump when it
    has seen a block; a block that ends some pattern selects, by its hash, the
    patterns with that suffix, and of these, by the first block, the ones that
    are compared word by word.
    """

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]]):
        self.length = len(next(iter(patterns)))
        self.patterns = patterns
        self.jump: dict[tuple[bytes, bytes], int] = {}
        self.suffixes: dict[tuple[bytes, bytes], dict[tuple[bytes, bytes], list[tuple[bytes, ...]]]] = defaultdict(dict)
        m = self.length
        for p in patterns:
            for j in range(1, m):
                block = p[j - 1 : j + 1]
                self.jump[block] = min(self.jump.get(block, m - 1), m - 1 - j)
            self.suffixes[p[-2:]].setdefault(p[:2], []).append(p)

    def occurrences(self, text: list[bytes]):
        """(first word, pattern) of each occurrence."""
        m = self.length
        if m == 1:  # no block: the table of patterns is the bucket
            for k, word in enumerate(text):
                if (word,) in self.patterns:
                    yield k, (word,)
            return
        jump, far, at, n = self.jump.get, m - 1, m - 1, len(text)
        while at < n:
            skip = jump((text[at - 1], text[at]), far)
            if skip:
                at += skip
                continue
            start = at - m + 1
            bucket = self.suffixes[text[at - 1], text[at]]
            for p in bucket.get((text[start], text[start + 1]), ()):
                if all(a == b for a, b in zip(p, text[start : at + 1], strict=True)):
                    yield start, p
            at += 1


class Search:
    """Wu-Manber searches for the windows of a set of items, one for each length."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = defaultdict(lambda: defaultdict(list))
        for item, text in items:
            for w in set(windows(text, width)):
                by_length[len(w)][w].append(item)
        self.parts = [WuManber(dict(p)) for _, p in sorted(by_length.items())]

    def hits(self, text: list[bytes]) -> list[tuple[int, int, tuple[str, ...]]]:
        found = []
        for part in self.parts:
            for start, p in part.occurrences(text):
                found.append((start, start + part.length, tuple(part.patterns[p])))
        return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _searched(shared, width: int):
    """Adds a block's word spans and items to those that a row has already."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text", pa.string()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
         ("items", pa.list_(pa.string()))]
    )
    search: list[Search] = []

    def row(doc_id, text, starts, ends, items):
        if not search:
            search.append(Search(shared.value, width))
        found = search[0].hits(words(text))
        if found:
            spans = merged([*zip(starts, ends, strict=True), *((s, e) for s, e, _ in found)])
            starts, ends = zip(*spans, strict=True)
            items = sorted({*items, *(i for _, _, own in found for i in own)})
        return doc_id, text, starts, ends, items

    return by_row(row, schema)


def _counted():
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
         ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("starts", pa.list_(pa.int32())),
         ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]
    )

    def row(doc_id, text, starts, ends, items):
        n_hit = sum(ends) - sum(starts)
        digest = hashlib.sha256(",".join(items).encode()).hexdigest()
        return doc_id, len(words(text)), n_hit, len(items), digest, n_hit > 0, starts, ends, items

    return by_row(row, schema)


def item_blocks(items: DataFrame, width: int = WINDOW) -> list[list[tuple[str, str]]]:
    """The distinct items, in blocks of about ``BLOCK`` windows, each within bounds to broadcast.

    The benchmark is a stated set of queries, small beside the documents; its
    size is summed before a block is fetched, and blocks are fetched one by one.
    """
    own = items.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("body")
    ).distinct()
    own = durable(own)
    volume = own.agg(F.sum(F.length("body"))).first()[0] or 0
    n = 1 + volume // (4 * BLOCK)  # a window starts at a word, of three characters and a space or more on average
    if n == 1:
        return [[tuple(r) for r in own.sort("item", "body").collect()]]
    part = F.pmod(F.xxhash64("item"), F.lit(n))
    return [[tuple(r) for r in own.where(part == k).collect()] for k in range(n)]


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """What of ``items(item_id, text)`` occurs in each row of ``docs(doc_id, text)``.

    Returns ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` and
    the merged word spans (``starts``, ``ends``, end exclusive) and ``items``
    sorted as strings. Words are runs of digits, letters a-z (A-Z in lower
    case) and characters beyond ASCII. A window is ``width`` consecutive item
    words, an item of fewer words is one window. NULL and empty texts have no
    words; items without words or with a NULL id or text are ignored; repeated
    items and windows count once, a window of two items counts for both.
    Repeated document rows give repeated results. Extra columns are not read.
    """
    spark = docs.sparkSession
    empty = F.expr("cast(array() as array<int>)")
    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), empty.alias("starts"), empty.alias("ends"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    kind = "doc_id bigint, text string, starts array<int>, ends array<int>, items array<string>"
    for block in item_blocks(items, width):
        rows = rows.mapInArrow(_searched(spark.sparkContext.broadcast(block), width), kind)
    return rows.mapInArrow(
        _counted(),
        "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
        "starts array<int>, ends array<int>, items array<string>",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` without the rows in which a window of ``items`` occurs; all columns stay."""
    spark = docs.sparkSession
    for block in item_blocks(items, width):
        shared = spark.sparkContext.broadcast(block)
        docs = docs.mapInArrow(_without_hits(shared, width, docs.columns.index("text")), docs.schema)
    return docs


def _without_hits(shared, width: int, at: int):
    def run(batches):
        search = Search(shared.value, width)
        for got in batches:
            clean = [not any(search.hits(words(t))) for t in got.column(at).cast(pa.string()).to_pylist()]
            yield got.filter(pa.array(clean))

    return run
