"""The event stream: connectors, parsing and rejects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import scalars
from clickloom.model import EVENT_SCHEMA

RAW_SCHEMA = "value binary, timestamp timestamp"


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Records of a topic as a stream of (value, timestamp).

    Needs the Kafka connector on the class path of the cluster.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**(options or {}))
        .load()
        .select("value", "timestamp")
    )


def file_source(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON lines under a directory as a stream of (value, timestamp)."""
    reader = spark.readStream.schema("value string")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format("text").load(path).select(
        F.col("value").cast("binary").alias("value"), F.current_timestamp().alias("timestamp")
    )


def parse_events(raw: DataFrame, rejects: bool = False) -> DataFrame:
    """Typed events of JSON records; records without a type are left out.

    ``rejects`` keeps these, with a NULL event type and their text. A missing
    event id is derived from the record, so a repeated delivery gets the same
    id. A payload that is no object becomes ``{info: text}``. A category at the
    top level moves into ``data``.
    """
    text = F.col("value").cast("string")
    parsed = raw.select(text.alias("_raw"), F.from_json(text, EVENT_SCHEMA).alias("e"))
    data = F.coalesce("e.data", scalars.payload_map(F.get_json_object("_raw", "$.data")))
    flat = F.col("e.category").isNotNull() & F.try_element_at(data, F.lit("category")).isNull()
    merged = F.when(
        flat, F.map_concat(F.map_filter(data, lambda k, v: k != "category"),
                           F.create_map(F.lit("category"), F.col("e.category")))
    ).otherwise(data)
    known = parsed if rejects else parsed.filter(F.col("e.event_type").isNotNull())
    return known.select(
        F.coalesce("e.event_id", F.sha2("_raw", 256)).alias("event_id"),
        F.col("e.user_id").alias("user_id"),
        F.col("e.event_type").alias("event_type"),
        merged.alias("data"),
        F.try_to_timestamp("e.timestamp").alias("ts"),
        F.col("e.session_id").alias("session_id"),
        F.col("_raw").alias("raw"),
    )


def rejected_events(raw: DataFrame) -> DataFrame:
    """Records that are not events: broken JSON or no event type."""
    text = F.col("value").cast("string")
    parsed = raw.select(text.alias("raw"), F.from_json(text, EVENT_SCHEMA).alias("e"))
    return parsed.filter(F.col("e.event_type").isNull()).select("raw")
