"""URL filter: host and path rules, and logistic regression on hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: n-gram sizes, hash buckets, weight of the ridge penalty.
SIZES, BUCKETS, PENALTY = (3, 4, 5), 1 << 14, 1e-4
#: A URL without a fitting rule is blocked from this probability on: a wrong block loses a page for good.
THRESHOLD = 0.8
#: Rows that a labelled table may have at most; a larger one is an error, not a sample.
LABELLED_ROWS = 100_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (
    Rule("allow", "com"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

#: The small labelled table: general words of the kinds of sites that curated lists block and of others, no host
#: label of the supplied pages, and forms in which both occur alike, so that neither prefix nor path tells them apart.
BLOCKED_SITES = (
    "casino roulette-wheel slot-machine jackpot blackjack baccarat betting bookmaker wagers sportsbook poker-room lottery-winner "
    "porn porn-tube xxx-videos adult-video adult-entertainment erotic nude-cams escort-girls sex-chat fetish viagra viagra-tablets cialis-online pharmacy-discount "
    "steroids weight-loss-miracle phishing-login malware-download trojan-loader keygen-crack warez torrent-movies "
    "payday-loan instant-credit free-money get-rich-quick miracle-cure replica-watches fake-diploma spam-mailer "
    "link-exchange click-tracker popup-adverts adserver banner-network"
).split()
OTHER_SITES = (
    "library garden-plants weather-report university news-daily history cooking-recipes museum software travel-guide city-council "
    "science theatre public-transport primary-school music-lessons encyclopedia parliament hospital chess-club archive "
    "radio railways bakery maps reading nature-reserve birds astronomy geography orchestra-hall fire-brigade football-club "
    "mathematics engineering literature local-government photography health-service bicycle-repair"
).split()
PREFIXES = ("", "www.", "blog.", "m.")
PATHS = ("/en/12", "/de/2520.html", "/fr/825/", "/es/338", "/en/41.html", "/", "/en/18044/", "/de/9", "/fr/7801", "/es/51/")


def labelled_rows() -> list[tuple[str, int]]:
    """Each site under three prefixes and paths; label 1 is to be blocked."""
    return [
        (f"http://{PREFIXES[(k + turn) % 4]}{site}.example{PATHS[(3 * k + turn) % 10]}", label)
        for sites, label in ((BLOCKED_SITES, 1), (OTHER_SITES, 0))
        for k, site in enumerate(sites)
        for turn in range(3)
    ]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for NULL or a URL without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, NULL where none does.

    A rule fits its host and all subdomains if the path starts with the rule's.
    Of two of one length the one with the longer host wins, then a block.
    """
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.verdict == "block")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def buckets(host: str, path: str) -> list[int]:
    """Hash buckets of the distinct n-grams of host and path, each part marked at its ends."""
    found = set()
    for part, marked in ((b"h", f"^{host}$".encode()), (b"p", f"^{path.lower()}$".encode())):
        for n in SIZES:
            for k in range(len(marked) - n + 1):
                found.add(xxhash.xxh64_intdigest(part + marked[k : k + n]) % BUCKETS)
    return sorted(found)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    intercept: float

    def probability(self, host: str, path: str) -> float:
        own = buckets(host, path)
        margin = self.intercept + (float(self.weights[own].sum()) / len(own) ** 0.5 if own else 0.0)
        return 1 / (1 + float(np.exp(-margin)))


def labelled_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(labelled_rows(), "url string, label int")


def train(labelled: DataFrame) -> Model:
    """Fit ``label`` 0 or 1 of ``labelled(url, label)``; rows with a NULL count for nothing.

    The table is small by agreement: one of more than ``LABELLED_ROWS`` rows is
    refused. There is no intercept, so a URL without known n-grams is at one
    half. Without both labels every probability is that of the table, or 0.
    """
    host, path = host_and_path(F.col("url"))
    rows = labelled.where("url is not null and label in (0, 1)").select(
        host.alias("host"), path.alias("path"), F.col("label").cast("double").alias("label")
    )
    seen = rows.groupBy("label").count().collect()
    if sum(r["count"] for r in seen) > LABELLED_ROWS:
        raise ValueError(f"the labelled table has more than {LABELLED_ROWS} rows")
    if len(seen) < 2:
        return Model(np.zeros(BUCKETS), 30.0 if seen and seen[0].label else -30.0)

    def vector(host, path):
        own = buckets(host, path)
        return Vectors.sparse(BUCKETS, own, [len(own) ** -0.5] * len(own))

    data = rows.coalesce(1).sort("label", "host", "path").withColumn("features", F.udf(vector, VectorUDT())("host", "path"))
    learner = LogisticRegression(maxIter=100, regParam=PENALTY, standardization=False, fitIntercept=False)
    return Model(learner.fit(data).coefficients.toArray(), 0.0)


def judge_urls(pages: DataFrame, model: Model, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict, probability`` of every row of ``pages(page_id, url)``.

    The longest fitting rule decides; where none fits, the model does: block
    from a probability of ``threshold`` on. A NULL URL and one without ``://``
    have an empty host and path, no n-grams and so a probability of one half.
    Repeated rows give repeated rows; extra columns are
    not read.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("bigint"), host.alias("host"), path.alias("path"))
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("probability", pa.float64())])

    def run(batches):
        for got in batches:
            pairs = zip(got.column(1).to_pylist(), got.column(2).to_pylist(), strict=True)
            scores = pa.array([model.probability(h, p) for h, p in pairs], pa.float64())
            yield pa.RecordBatch.from_arrays([*got.columns, scores], schema=schema)

    scored = rows.mapInArrow(run, "page_id bigint, host string, path string, probability double")
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("probability") >= threshold, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "probability"
    )
