"""Batch sinks, stream sinks and model storage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str] = ("category",)) -> None:
    """Overwrite a Parquet table partitioned by the columns.

    Rows of a value are brought together and dealt out by size: small values
    share a task, a hot one gets as many writers as it has advisory partitions.
    """
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .partitionBy(*columns)
        .parquet(path)
    )


def write_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_batch(
    df: DataFrame, path: str, batch_id: int, writer: str = "batch", ts: str = "ts"
) -> None:
    """Append one micro-batch by date; writing the same batch again replaces it.

    Only the (date, writer, batch) directories of this batch are overwritten, so
    a replay after a failure neither loses nor repeats rows, and a stream that
    starts anew under another writer replaces nothing.
    """
    rows = df.withColumns(
        {"event_date": F.to_date(ts), "writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("long")}
    )
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "writer", "batch_id")
        .parquet(path)
    )


def append_raw_events(events: DataFrame, path: str, batch_id: int, writer: str = "batch") -> None:
    """Keep the whole text of every event."""
    rows = events.select(
        "user_id", "event_type", F.col("raw").alias("event_data"), "ts"
    )
    append_batch(rows, path, batch_id, writer)


def append_interactions(
    interactions: DataFrame, path: str, batch_id: int, writer: str = "batch"
) -> None:
    append_batch(interactions, path, batch_id, writer)


def kafka_sink(
    df: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Forward a stream of rows as JSON to a topic."""
    return (
        as_messages(df)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .options(**(options or {}))
        .start()
    )


def as_messages(df: DataFrame) -> DataFrame:
    """Key and JSON value of each row; the key keeps a user's events in order."""
    columns = [c for c in df.columns if c != "raw"]
    key = F.col("user_id").cast("string") if "user_id" in df.columns else F.lit(None).cast("string")
    return df.select(key.alias("key"), F.to_json(F.struct(*columns)).alias("value"))


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_als(path: str):
    from pyspark.ml.recommendation import ALSModel

    return ALSModel.load(path)
