"""Total-order ranking helpers that stay safe when one key is very hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPREAD = 32


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    *,
    rank: str = "rank",
    spread_by: str | None = None,
    spread: int = SPREAD,
) -> DataFrame:
    """First ``n`` rows of each group under a total order, ranked from 1.

    Spark prunes ``row_number() <= n`` inside each map task already. With
    ``spread_by`` (a row id) the groups are first cut to ``n`` rows in
    ``spread`` slices, so even a group that holds a third of the table sends at
    most ``spread * n`` rows to the task that finishes it. The slice follows
    from the row id, hence a re-run task makes the same slices.
    """
    order = list(order)
    if spread_by is not None:
        piece = F.pmod(F.xxhash64(spread_by), F.lit(spread))
        sliced = Window.partitionBy(*keys, piece).orderBy(*order)
        df = df.withColumn("_slice_rank", F.row_number().over(sliced))
        df = df.filter(F.col("_slice_rank") <= n).drop("_slice_rank")
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= n)


def seeded_key(product_id: Column, seed: str | int) -> Column:
    """Repeatable shuffle key of a product for one seed."""
    return F.md5(F.concat(product_id.cast("string"), F.lit(f":{seed}")))


def best_key(weight: Column, key: Column) -> Column:
    """Aggregate: the key of largest weight, smallest key on a tie.

    Rows whose key is NULL do not compete.
    """
    entry = F.when(key.isNotNull(), F.struct((-weight).alias("w"), key.alias("k")))
    return F.min(entry)["k"]
