"""Time the headline queries; prints one JSON line.

Each query runs once to warm up, then the median of three runs counts. A run
builds the plan and writes the whole result to the no-op sink, so every column
of every row is computed and nothing is collected. Two streaming aggregates are
timed over all available events.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from clickloom.registry.queries import QUERIES  # noqa: E402
from clickloom.sources.session import RECOMMENDED  # noqa: E402
from clickloom.streaming import stateful  # noqa: E402

HEADLINE = (
    "category_preferences",
    "purchase_preferences",
    "trending_products",
    "user_segments_rule",
    "user_features",
    "implicit_ratings",
    "recent_per_user",
    "recency_weighted_scores",
    "top_products_trend",
    "category_performance",
    "gap_sessions",
    "user_event_lists",
    "hybrid_blend",
    "content_similarity",
    "refresh_recommendations",
    "recommend_cascade",
    "recommend_same_plus_related",
    "recommend_instant_switch",
    "recommend_recency_8_2",
    "train_als",
    "recommend_for_all",
)
RUNS = 3


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("clickloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, sf: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def stream_events(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream of shop events with their product."""
    raw = spark.readStream.schema(spark.read.parquet(f"{sf}/events.parquet").schema)
    raw = raw.option("pathGlobFilter", "events.parquet").parquet(sf)
    product = F.get_json_object("props", "$.k")
    data = F.create_map(F.lit("product_id"), product, F.lit("action"), F.lit("view_product"))
    kind = F.when(F.col("event_type") == "view", "product_view").otherwise(F.col("event_type"))
    return raw.select(
        "user_id", kind.alias("event_type"), F.col("event_type").alias("interaction_type"), data.alias("data"), "ts"
    )


def stream_rate(spark: SparkSession, sf: str, build, mode: str) -> int:
    """Events a second of a streaming aggregate over all that is available."""
    n = spark.read.parquet(f"{sf}/events.parquet").count()
    with tempfile.TemporaryDirectory(prefix="bench-") as checkpoint:
        start = time.perf_counter()
        writer = build(stream_events(spark, sf)).writeStream.format("noop").outputMode(mode)
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return round(n / (time.perf_counter() - start))


STREAMS = {
    "stream_product_counters": (stateful.stream_product_counters, "update"),
    "stream_timeline": (stateful.stream_timeline, "append"),
}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = session(cpus)
    times = {}
    for name in names:
        timed(spark, name, sf)
        times[name] = round(statistics.median(timed(spark, name, sf) for _ in range(RUNS)), 3)
        print(f"{name:32s} {times[name]:8.3f}", file=sys.stderr, flush=True)
    rates = {}
    if not sys.argv[1:]:
        for name, (build, mode) in STREAMS.items():
            stream_rate(spark, sf, build, mode)
            rates[name] = stream_rate(spark, sf, build, mode)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "stream_rows_per_second": rates,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
