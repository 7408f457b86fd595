"""Quality classifier: random Fourier features, ridge by normal equations, isotonic calibration."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import by_row, durable
from clickloom.llm.quality_rules import SPACES, repeated_window_words

STATISTICS = (
    "log_words", "word_length", "symbols", "marks", "upper", "digits", "beyond_ascii", "same_lines",
    "repeated_windows", "distinct_words", "most_common_word", "line_length", "sentence_ends", "word_spread",
)

#: Random features, their seed, the ridge weight on the mean of squares, bins of the calibration.
FEATURES, SEED, RIDGE, BINS = 256, 20240117, 1e-3, 2000
#: A document is kept from this score on.
THRESHOLD = 0.3


def statistics(text: str | None) -> tuple[float, ...]:
    """The document statistics named in ``STATISTICS``; all finite, also for texts without words."""
    text = text or ""
    words = text.encode().split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATISTICS)
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    sizes = np.fromiter(map(len, words), np.int64, n)
    codes = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    chars = len(text)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    upper, lower, digits = int(codes[65:91].sum()), int(codes[97:123].sum()), int(codes[48:58].sum())
    marks = int(codes[33:127].sum()) - upper - lower - digits
    ends = int(codes[46] + codes[33] + codes[63])
    symbols = int(codes[list(b"#*$%&|<>")].sum())
    return (
        math.log1p(n),
        float(sizes.mean()),
        symbols / n,
        marks / n,
        upper / (upper + lower + 1),
        digits / chars,
        (chars - int(codes[:128].sum())) / chars,
        1 - len(set(lines)) / len(lines),
        repeated_window_words(ids) / n,
        len(index) / n,
        int(np.bincount(ids).max()) / n,
        math.log1p(n / len(lines)),
        ends / n,
        float(sizes.std()),
    )


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``x``, the statistics of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(by_row(lambda i, t: (i, statistics(t)), schema), "doc_id bigint, x array<double>")


def fold(doc_id: Column) -> Column:
    """CRC-32 of the id as text, modulo 5; 0 is held out. A NULL id is held out, too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


@dataclass(frozen=True)
class Classifier:
    """A fitted model: scaling, random features, ridge weights, calibration knots."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        return random_features((x - self.mean) / self.scale)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated scores in 0 to 1. A thousandth of the score follows the
        raw value, so texts on one step of the calibration keep their order."""
        if not len(self.knots):
            return np.full(len(x), 0.5)
        raw = self.raw(x)
        level = np.interp(raw, self.knots, self.levels)
        return np.round(0.999 * level + 0.001 / (1 + np.exp(-np.clip(raw - 0.5, -30, 30))), 9)


def random_features(z: np.ndarray) -> np.ndarray:
    """Cosines whose inner products approximate a Gaussian kernel of width sqrt(dimensions), and a constant."""
    rng = np.random.default_rng(SEED)
    d = z.shape[1]
    directions = rng.standard_normal((d, FEATURES)) / math.sqrt(d)
    phases = rng.uniform(0, 2 * math.pi, FEATURES)
    waves = math.sqrt(2 / FEATURES) * np.cos(np.clip(z, -8, 8) @ directions + phases)
    return np.hstack([waves, np.ones((len(z), 1))])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy().reshape(len(column), -1) if len(column) else np.empty((0, len(STATISTICS)))


def _summed(frame: DataFrame, partial, size: int) -> np.ndarray:
    """The sum over all rows of what ``partial`` gives for a batch; partitions are summed before they are sent.

    The sums of all partitions meet in a few tasks, and only those tasks' sums
    reach the driver: ``size`` doubles each. A partition or task without rows
    sends nothing, however many of them a shuffle has.
    """
    schema = pa.schema([("part", pa.int64()), ("total", pa.binary())])

    def own(batches):
        total, some = np.zeros(size), False
        for got in batches:
            if got.num_rows:
                total, some = total + partial(got), True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([hash(total.tobytes()) % 8]), pa.array([total.tobytes()], pa.binary())], schema=schema)

    def merge(batches):
        total, some = np.zeros(size), False
        for got in batches:
            for value in got.column(1).to_pylist():
                total, some = total + np.frombuffer(value), True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([total.tobytes()], pa.binary())], schema=schema)

    sums = frame.mapInArrow(own, "part bigint, total binary")
    sums = sums.repartition(8, "part").mapInArrow(merge, "part bigint, total binary")
    return sum((np.frombuffer(r.total) for r in sums.collect()), np.zeros(size))


def isotonic(values: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit, by pooling adjacent violators."""
    blocks: list[list[float]] = []  # mean position x count, label sum, count
    for v, s, c in zip(values, sums, counts, strict=True):
        blocks.append([v * c, s, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def train(rows: DataFrame, labels: DataFrame) -> Classifier:
    """Fit on the rows of ``document_statistics`` that ``labels(doc_id, quality)`` marks.

    Every labelled row outside fold 0 is used: folds 1 to 3 for scaling and
    ridge weights, fold 4 for the calibration. Labels other than 0 and 1 and
    NULLs are ignored; a document labelled twice counts twice. Without usable
    labels every score is 0.5.
    """
    marked = labels.where("quality in (0, 1)").select(F.col("doc_id").alias("label_id"), F.col("quality").cast("double").alias("y"))
    used = rows.join(marked, F.col("doc_id") == F.col("label_id")).select(fold(F.col("doc_id")).alias("fold"), "x", "y")
    used = durable(used.where("fold > 0"))
    d = len(STATISTICS)

    fitting = used.where("fold < 4").select("x", "y")
    moments = _summed(
        fitting,
        lambda got: np.r_[len(got.column(1)), (x := _matrix(got.column(0))).sum(0), (x * x).sum(0)],
        2 * d + 1,
    )
    n = moments[0]
    if not n:
        return Classifier(np.zeros(d), np.ones(d), np.zeros(FEATURES + 1), np.empty(0), np.empty(0))
    mean = moments[1 : d + 1] / n
    scale = np.sqrt(np.maximum(moments[d + 1 :] / n - mean**2, 0))
    scale[scale < 1e-9] = 1.0

    k = FEATURES + 1

    def normal(got):
        z = random_features((_matrix(got.column(0)) - mean) / scale)
        y = got.column(1).to_numpy()
        return np.r_[(z.T @ z).ravel(), z.T @ y]

    sums = _summed(fitting, normal, k * k + k)
    ridge = RIDGE * n * np.diag(np.r_[np.ones(FEATURES), 0.0])
    weights = np.linalg.solve(sums[: k * k].reshape(k, k) + ridge, sums[k * k :])
    model = Classifier(mean, scale, weights, np.empty(0), np.empty(0))

    def binned(got):
        raw = np.clip(model.raw(_matrix(got.column(0))), -0.5, 1.499)
        place = ((raw + 0.5) / 2 * BINS).astype(int)
        y = got.column(1).to_numpy()
        return np.r_[
            np.bincount(place, minlength=BINS), np.bincount(place, y, BINS), np.bincount(place, raw, BINS)
        ]

    chosen = used.where("fold = 4").select("x", "y")
    table = _summed(chosen, binned, 3 * BINS).reshape(3, BINS)
    if not table[0].any():
        table = _summed(fitting, binned, 3 * BINS).reshape(3, BINS)
    full = table[0] > 0
    counts, sums, places = table[0][full], table[1][full], table[2][full] / table[0][full]
    return Classifier(mean, scale, weights, *isotonic(places, sums, counts))


def score(rows: DataFrame, model: Classifier) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of rows of ``document_statistics``."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for got in batches:
            if got.num_rows:
                yield pa.RecordBatch.from_arrays([got.column(0), pa.array(model.score(_matrix(got.column(1))))], schema=schema)

    scored = rows.select("doc_id", "x").mapInArrow(run, "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs(doc_id, text)``.

    ``score`` is the calibrated probability of label 1, from statistics of the
    whole text alone. NULL and empty texts have the statistics of a text
    without words and get a score like any other; repeated rows give repeated
    rows; extra columns are not read; an empty table gives an empty result.
    """
    rows = durable(document_statistics(docs))
    return score(rows, train(rows, labels))


def drop_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score of ``THRESHOLD`` or more, all columns kept."""
    labelled = labels.select(F.col("doc_id").alias("label_id")).where("label_id is not null").distinct()
    rows = docs.select("doc_id", "text").join(labelled, F.col("doc_id") == F.col("label_id"), "left_semi")
    model = train(document_statistics(rows), labels)
    at = docs.columns.index("text")

    def run(batches):
        for got in batches:
            texts = got.column(at).cast(pa.string()).to_pylist()
            if texts:
                scores = model.score(np.array([statistics(t) for t in texts]))
                yield got.filter(pa.array(scores >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
