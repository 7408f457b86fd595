"""Batch sources: stored tables and the relational import."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.times import AsOf, trailing_window


def read_parquet_table(spark: SparkSession, path: str, **equals) -> DataFrame:
    """A Parquet table; equalities on partition columns prune its directories and
    on other columns are pushed to the scan."""
    df = spark.read.parquet(path)
    for column, value in equals.items():
        df = df.filter(F.col(column) == value)
    return df


def load_interactions(
    interactions: DataFrame, products: DataFrame, as_of: AsOf, days: int = 30
) -> DataFrame:
    """Interactions of the window with category, price and name of their product."""
    goods = products.select("product_id", "category", "price", F.col("name").alias("product_name"))
    return trailing_window(interactions, as_of, days=days).join(goods, "product_id")


def load_raw_events(raw: DataFrame, as_of: AsOf, days: int = 7) -> DataFrame:
    return trailing_window(raw, as_of, days=days)


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    partition_column: str | None = None,
    partitions: int = 32,
) -> DataFrame:
    """A relational table; with a numeric column it is read by parallel ranges.

    The bounds of the ranges come from a one-row query pushed to the database.
    """
    reader = spark.read.format("jdbc").options(**options)
    if partition_column is None:
        return reader.option("dbtable", table).load()
    bounds = (
        reader.option(
            "query",
            f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}",
        )
        .load()
        .first()
    )
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if bounds[0] is None:
        return reader.load()
    return (
        reader.option("partitionColumn", partition_column)
        .option("lowerBound", str(bounds[0]))
        .option("upperBound", str(bounds[1] + 1))
        .option("numPartitions", str(partitions))
        .load()
    )


def import_relational(source: DataFrame, path: str) -> int:
    """Copy a relational table to Parquet and verify the number of rows.

    The expected number comes from counting the source; reading it twice is the
    price of a check that does not trust the copy.
    """
    source.write.mode("overwrite").parquet(path)
    written = source.sparkSession.read.parquet(path).count()
    expected = source.count()
    if written != expected:
        raise ValueError(f"{path}: {written} rows written, {expected} in the source")
    return written


def enriched_interactions(interactions: DataFrame, products: DataFrame) -> DataFrame:
    """The stored fact table of the analysis jobs: interactions with product
    columns, time columns and the engagement score."""
    from clickloom.functions.weights import ENGAGEMENT
    from clickloom.operators.joins import interactions_left_product
    from clickloom.operators.projections import with_score, with_time_columns

    goods = products.select("product_id", "category", "price", F.col("name").alias("product_name"))
    rows = interactions_left_product(interactions, goods)
    return with_score(with_time_columns(rows), ENGAGEMENT, "interaction_score")


def load_json_results(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Stored insight or metric documents."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)
