"""Keyed result tables with a time to live, kept as versions.

A publish writes only the changed rows, as one directory per writer and
version; a reader folds what it finds. Every writer has its own versions, so a
stream and a batch job can share a table, and publishing a version again
replaces it, which makes a replayed micro-batch harmless. Rows lie in buckets
by a hash of their key, so a reader of a few keys opens their buckets only.
``compact`` folds versions into a base and records which ones the base holds;
whatever it does not hold is read beside it, whenever it was published.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.times import AsOf, to_datetime

# Time to live per result family, in seconds.
DAY = 86_400
TTL = {
    "user_preferences": 7 * DAY,
    "recommendations": 3 * DAY,
    "recommendation_details": 3_600,
    "trending_products": DAY,
    "user_segment": 7 * DAY,
    "recent_views": 7 * DAY,
    "search_history": 30 * DAY,
    "page_views": 7 * DAY,
    "product_stats": 30 * DAY,
    "recommendation_stats": 7 * DAY,
    "user_profile": 30 * DAY,
}
BUCKETS = 16
BASE = "base"
Fold = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Version:
    """A complete version directory; ``written`` tells a later one of the same name apart."""

    writer: str
    number: int
    written: int

    @property
    def folder(self) -> str:
        return f"_w={self.writer}/_v={self.number}"


def _file_system(spark: SparkSession, path: str):
    """Hadoop file system and path class of a location."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def _complete(spark: SparkSession, path: str) -> list[Version]:
    """Versions whose job has left ``_SUCCESS``, found by one listing."""
    fs, path_of = _file_system(spark, path)
    found = []
    for status in fs.globStatus(path_of(f"{path}/data/_w=*/_v=*/_SUCCESS")) or ():
        folder = status.getPath().getParent()
        writer = folder.getParent().getName().removeprefix("_w=")
        found.append(Version(writer, int(folder.getName().removeprefix("_v=")), status.getModificationTime()))
    return sorted(found, key=lambda v: (v.writer, v.number))


def _base(spark: SparkSession, versions: list[Version], path: str) -> tuple[Version | None, set[Version]]:
    """The newest base and the versions that it holds."""
    bases = [v for v in versions if v.writer == BASE]
    if not bases:
        return None, set()
    rows = spark.read.text(f"{path}/folded/{bases[-1].number}").collect()
    return bases[-1], {Version(*json.loads(r.value)) for r in rows}


def bucket_of(keys: Sequence[str]) -> Column:
    """Bucket of a key; the same for any integer width of its columns."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(BUCKETS)).cast("int")


def publish_version(rows: DataFrame, path: str, keys: Sequence[str], version: int, writer: str) -> None:
    """Write rows as one version; a version of the same writer and number is replaced."""
    if writer == BASE:
        raise ValueError(f"{BASE} names the folded versions")
    _write(rows.withColumns({"_writer": F.lit(writer), "_version": F.lit(version).cast("long")}), path, keys, writer, version)


def _write(rows: DataFrame, path: str, keys: Sequence[str], writer: str, version: int) -> None:
    out = rows.withColumn("_bucket", bucket_of(keys)).hint("rebalance", "_bucket")
    out.write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/data/_w={writer}/_v={version}")


def history(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = (),
    only: DataFrame | None = None,
    before: tuple[str, int] | None = None,
) -> DataFrame | None:
    """The base and all versions that it does not hold, as one set of rows.

    ``only`` restricts the rows to the keys it holds: buckets without such keys
    are not opened. ``before`` (a writer and a number) leaves out this version
    and later ones of the writer, so a replayed batch does not read its own
    output. NULL where nothing has been written.
    """
    versions = _complete(spark, path)
    base, folded = _base(spark, versions, path)
    chosen = [v for v in versions if v.writer != BASE and v not in folded]
    if before is not None:
        chosen = [v for v in chosen if v.writer != before[0] or v.number < before[1]]
    if base is not None:
        chosen.append(base)
    folders = [f"{path}/data/{v.folder}" for v in chosen]
    fs, path_of = _file_system(spark, path)
    folders = [f for f in folders if len(fs.globStatus(path_of(f"{f}/_bucket=*")) or ()) > 0]
    if not folders:
        return None
    rows = spark.read.option("basePath", f"{path}/data").option("mergeSchema", "true").parquet(*folders)
    if only is not None:
        wanted = only.select(*keys).distinct()
        # at most ``BUCKETS`` numbers
        buckets = [r._bucket for r in wanted.select(bucket_of(keys).alias("_bucket")).distinct().collect()]
        rows = rows.where(F.col("_bucket").isin(buckets)).join(wanted, list(keys), "left_semi")
    return rows.withColumn("_late", F.col("_w") != BASE).drop("_w", "_v", "_bucket")


def compact_versions(
    spark: SparkSession, path: str, keys: Sequence[str], fold: Fold, keep: int = 1
) -> None:
    """Fold versions into a new base with ``fold`` over the rows of ``history``.

    The newest ``keep`` versions of each writer stay beside the base, as their
    batch may still be replayed. A base counts once its list of versions and
    its rows are written, in this order, so a compaction that dies changes
    nothing. Versions that the base before held already are removed; those
    folded now stay until the next compaction, for running readers.
    """
    versions = _complete(spark, path)
    base, folded = _base(spark, versions, path)
    own = [v for v in versions if v.writer != BASE]
    last = {w: [v.number for v in own if v.writer == w][-keep:] for w in {v.writer for v in own}}
    settled = {v for v in own if v.number not in last[v.writer]}
    if not settled - folded:
        return
    chosen = [*(settled - folded), *([base] if base else [])]
    rows = spark.read.option("basePath", f"{path}/data").option("mergeSchema", "true").parquet(
        *[f"{path}/data/{v.folder}" for v in chosen]
    )
    rows = rows.withColumn("_late", F.col("_w") != BASE).drop("_w", "_v", "_bucket")
    number = base.number + 1 if base else 0
    listed = [(json.dumps([v.writer, v.number, v.written]),) for v in sorted(settled | (folded & set(own)), key=repr)]
    spark.createDataFrame(listed, "value string").coalesce(1).write.mode("overwrite").text(f"{path}/folded/{number}")
    _write(fold(rows).drop("_late"), path, keys, BASE, number)
    fs, path_of = _file_system(spark, path)
    for v in folded & set(own):
        fs.delete(path_of(f"{path}/data/{v.folder}"), True)
    for v in [v for v in versions if v.writer == BASE][:-1]:
        fs.delete(path_of(f"{path}/data/{v.folder}"), True)
        fs.delete(path_of(f"{path}/folded/{v.number}"), True)


# ------------------------------------------------------------------ upserts


def _stamp(as_of: AsOf) -> Column:
    return F.lit(to_datetime(as_of).isoformat(sep=" ")).cast("timestamp_ntz")


def publish_keyed(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    ttl: int,
    as_of: AsOf | Column,
    version: int,
    writer: str = "batch",
) -> None:
    """Upsert rows: they replace older rows of the same key and live ``ttl`` seconds.

    ``as_of`` is the time of the write, or a column that gives it for each row.
    """
    now = as_of.cast("timestamp_ntz") if isinstance(as_of, Column) else _stamp(as_of)
    rows = df.withColumn("updated_at", now)
    rows = rows.withColumn("expires_at", F.col("updated_at") + F.expr(f"INTERVAL {int(ttl)} SECONDS"))
    publish_version(rows, path, keys, version, writer)


def newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The latest row of each key by time, then version, writer, and a version before the base."""
    order = F.struct("updated_at", "_version", "_writer", "_late")
    values = F.struct(*[c for c in rows.columns if c not in keys])
    latest = rows.groupBy(*keys).agg(F.max_by(values, order).alias("_row"))
    return latest.select(*keys, "_row.*")


def live(rows: DataFrame, as_of: AsOf) -> DataFrame:
    return rows.where(F.col("expires_at") > _stamp(as_of))


def read_keyed(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    as_of: AsOf,
    schema: str | None = None,
    only: DataFrame | None = None,
    before: tuple[str, int] | None = None,
) -> DataFrame:
    """Live rows of a keyed table. ``schema`` describes a table not yet written.

    ``only`` and ``before`` are those of ``history``.
    """
    rows = history(spark, path, keys, only, before)
    if rows is None:
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    return live(newest(rows, keys), as_of).drop("_version", "_writer", "_late")


def compact(spark: SparkSession, path: str, keys: Sequence[str], as_of: AsOf, keep: int = 1) -> None:
    """Fold the versions of a keyed table into one base without expired rows."""
    compact_versions(spark, path, keys, lambda rows: live(newest(rows, keys), as_of), keep)


def writer_of(spark: SparkSession, checkpoint: str, name: str) -> str:
    """The writer of a stream: a name kept in its checkpoint folder, so a stream
    that starts anew numbers its batches in a new space."""
    fs, path_of = _file_system(spark, checkpoint)
    file = path_of(f"{checkpoint}/writer")
    if not fs.exists(file):
        out = fs.create(file, False)
        out.writeUTF(f"{name}-{spark._jvm.java.util.UUID.randomUUID()}")
        out.close()
    stream = fs.open(file)
    try:
        return stream.readUTF()
    finally:
        stream.close()
