"""Quality rules as a ledger of failure bits, judged by versioned policies."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import by_row

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "longest_word", "n_distinct_words",
)

#: Bit k is set where rule k fails. Rules are only ever added at the end, so a
#: stored ledger stays readable; each is a condition on the measurements.
RULES: dict[str, Callable[[dict[str, Column]], Column]] = {
    "few_words": lambda m: m["n_words"] < 50,
    "repeated_windows": lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"],
    "many_symbols": lambda m: 10 * m["n_symbols"] > 3 * m["n_words"],
    "repeated_lines": lambda m: 100 * m["n_dup_lines"] > 30 * m["n_lines"],
    "upper_case": lambda m: 10 * m["n_upper"] > 3 * m["n_letters"],
    "short_words": lambda m: m["word_chars"] < 2 * m["n_words"],
    "long_words": lambda m: m["word_chars"] > 15 * m["n_words"],
    "many_words": lambda m: m["n_words"] > 1_000_000,
}


def bits(*names: str) -> int:
    order = list(RULES)
    return sum(1 << order.index(n) for n in names)


#: A policy rejects a document if any of its bits is set in the ledger. A
#: version is never changed once it is in use; a change is a new version.
POLICIES = {
    "base": bits("few_words", "repeated_windows"),
    "v1": bits("few_words", "repeated_windows", "many_symbols", "upper_case"),
    "v2": bits(*RULES) & ~bits("many_words", "repeated_lines"),
}
CURRENT = "v2"


def repeated_window_words(ids: np.ndarray) -> int:
    """Words that lie in a window of three words found twice or more."""
    n = len(ids) - 2
    if n < 2:
        return 0
    base = int(ids.max()) + 1
    if base**3 < 2**62:
        windows = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
    else:
        _, first = np.unique(ids[:-2] * base + ids[1:-1], return_inverse=True)
        windows = first * base + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : k + n] |= again
    return int(covered.sum())


def measure(doc_id, text: str | None) -> tuple:
    text = text or ""
    words = text.encode().split()
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    letters = text.encode("utf-32-le")
    points = np.frombuffer(letters, np.uint32)
    small, great = int(((points >= 97) & (points <= 122)).sum()), int(((points >= 65) & (points <= 90)).sum())
    return (
        doc_id,
        len(words),
        len(text) - sum(text.count(c) for c in SPACES),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_window_words(ids),
        len(lines),
        great,
        small + great,
        max(map(len, words), default=0),
        len(index),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements and ``failed_bits`` of every row; each rule is evaluated once.

    Words are runs without ASCII white space. NULL and empty texts have no
    words and fail ``few_words``. Repeated rows give repeated rows. Extra
    columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64())] + [(m, pa.int64()) for m in MEASURES])
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    rows = rows.mapInArrow(by_row(measure, schema), ", ".join(f"{f.name} bigint" for f in schema))
    values = {m: F.col(m) for m in MEASURES}
    failed = F.lit(0).cast("bigint")
    for k, rule in enumerate(RULES.values()):
        failed = failed.bitwiseOR(F.when(rule(values), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint"))
    return rows.withColumn("failed_bits", failed)


def judge(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """A ledger with ``kept``: no bit of the policy's mask is set."""
    return rows.withColumn("kept", F.col("failed_bits").bitwiseAND(F.lit(POLICIES[policy])) == 0)


def ablations(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """What each rule of a policy does: ``rule, failed, alone, kept_without``.

    ``failed`` counts the rows that fail the rule, ``alone`` those that fail no
    other rule of the policy, ``kept_without`` the rows kept if the rule were
    left out. The ledger is first counted by its masks, of which there are at
    most two to the number of rules; the rest works on these counts.
    """
    mask = POLICIES[policy]
    counts = rows.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask)).alias("mask")).agg(F.count("*").alias("n"))
    named = [(n, 1 << k) for k, n in enumerate(RULES) if mask >> k & 1]
    per_rule = F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(b).cast("bigint").alias("bit")) for n, b in named))
    each = counts.select("mask", "n", F.explode(per_rule).alias("r")).select("mask", "n", "r.rule", "r.bit")
    has = F.col("mask").bitwiseAND(F.col("bit")) != 0
    only = F.col("mask") == F.col("bit")
    none = F.col("mask") == 0
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return each.groupBy("rule").agg(
        total(has).alias("failed"), total(only).alias("alone"), total(only | none).alias("kept_without")
    )
