"""Secret scan: keyword automaton, anchored expressions near hits, checksum validation."""

from __future__ import annotations

import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ASCII_LOWER, by_row

#: Kinds in their order at equal starts; the first three are the base.
KINDS = ("assign", "access", "hex", "github", "npm", "private_key")
BASE = 3

ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.ASCII)
HEX = re.compile(r"[0-9a-f]+", re.ASCII)
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])", re.ASCII)
NPM = re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])", re.ASCII)
PRIVATE_KEY = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", re.ASCII)

#: Keyword in lower case -> kind and the characters from the start of its expression to the keyword.
KEYWORDS = {
    "password": ("assign", 0), "passwd": ("assign", 0), "secret": ("assign", 0), "token": ("assign", 0),
    "api_key": ("assign", 0), "apikey": ("assign", 0), "akia": ("access", 0), "ghp_": ("github", 0),
    "gho_": ("github", 0), "ghu_": ("github", 0), "ghs_": ("github", 0), "ghr_": ("github", 0),
    "npm_": ("npm", 0), "-----begin ": ("private_key", 0),
}

HEX_RUN = 24
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_IS_HEX = np.zeros(256, bool)
_IS_HEX[list(b"0123456789abcdef")] = True


def checksum_holds(body: str) -> bool:
    """Whether the last six characters are the CRC-32 of the rest, in base 62."""
    value = zlib.crc32(body[:-6].encode())
    digits = ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = DIGITS[d] + digits
    return digits == body[-6:]


EXPRESSIONS = {
    "assign": (ASSIGN, lambda m: len(m[1]) >= 6),
    "access": (ACCESS, lambda m: len(m[0]) >= 20),
    "github": (GITHUB, lambda m: checksum_holds(m[1])),
    "npm": (NPM, lambda m: checksum_holds(m[1])),
    "private_key": (PRIVATE_KEY, lambda m: True),
}


def automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for word, (kind, before) in KEYWORDS.items():
        made.add_word(word, (kind, len(word) + before))
    made.make_automaton()
    return made


def hex_runs(data: bytes) -> list[tuple[int, int]]:
    """Runs of 24 or more lower-case hexadecimal digits.

    Such a run covers a multiple of 24 and the place 12 before or after it, so
    only where both hold a digit is a run matched, from its first digit on.
    """
    codes = np.frombuffer(data, np.uint8)
    anchors = np.arange(HEX_RUN - 1, len(codes), HEX_RUN)
    anchors = anchors[_IS_HEX[codes[anchors]]]
    if not len(anchors):
        return []
    half = HEX_RUN // 2
    after = np.minimum(anchors + half, len(codes) - 1)
    anchors = anchors[_IS_HEX[codes[anchors - half]] | (_IS_HEX[codes[after]] & (after > anchors))]
    out, over = [], 0
    for at in anchors.tolist():
        if at < over:
            continue
        start = at
        while start > over and _IS_HEX[codes[start - 1]]:
            start -= 1
        over = at + 1
        while over < len(codes) and _IS_HEX[codes[over]]:
            over += 1
        if over - start >= HEX_RUN:
            out.append((start, over))
    return out


def scan(text: str | None, search: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then kind as listed in ``KINDS``.

    Per kind the matches are leftmost and do not overlap: a keyword inside an
    earlier match of its kind is passed over, whether that match was good or not.
    """
    data = (text or "").encode()
    # each character of these strings stands for a byte; the expressions are ASCII
    plain, lower = data.decode("latin-1"), data.translate(ASCII_LOWER).decode("latin-1")
    starts: dict[str, list[int]] = {}
    for last, (kind, length) in search.iter(lower):
        starts.setdefault(kind, []).append(last + 1 - length)
    found = [(s, e, "hex") for s, e in hex_runs(data)]
    for kind, places in starts.items():
        expression, good = EXPRESSIONS[kind]
        over = 0
        for at in sorted(places):
            if at >= over and (m := expression.match(plain, at)):
                over = m.end()
                if good(m):
                    found.append((m.start(), over, kind))
    if not found:
        return []
    if len(data) != len(text):
        points = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        found = [(int(points[s]) - 1, int(points[e - 1]), kind) for s, e, kind in found]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def secret_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``spans`` (array of kind, start, end) of every row.

    NULL and empty texts have no spans; repeated rows give repeated rows; extra
    columns are not read. Offsets are code points, the end exclusive.
    """
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(kind))])
    made: list = []

    def row(doc_id, text):
        if not made:
            made.append(automaton())
        return doc_id, [{"kind": k, "start": s, "end": e} for s, e, k in scan(text, made[0])]

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(by_row(row, schema), "doc_id bigint, spans array<struct<kind:string,start:int,end:int>>")


def secret_report(docs: DataFrame) -> DataFrame:
    """``secret_spans`` as counts, the digest of the base spans and all spans as a string."""
    rows = secret_spans(docs)
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:BASE]))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return rows.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
