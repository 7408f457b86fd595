"""Building an ordered recommendation list inside one row.

A recommender states its stages as an ordered array of blocks: candidate product
ids, how many of them to take, and why. ``fill`` folds the blocks into one list.
Every array is bounded by a shelf length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.plans.shelves import no_ids

PICK_TYPE = "array<struct<product_id:bigint,priority:string,reason:string>>"
BLOCK_TYPE = "array<struct<ids:array<bigint>,take:int,priority:string,reason:string>>"


def block(ids: Column, take: int, priority: str, reason: Column) -> Column:
    """Candidates of one stage: at most ``take`` of ``ids``, in their order."""
    return F.struct(
        F.coalesce(ids, no_ids()).alias("ids"),
        F.lit(take).alias("take"),
        F.lit(priority).alias("priority"),
        reason.cast("string").alias("reason"),
    )


def blocks(test: Column, *entries: Column) -> Column:
    """The blocks if ``test`` holds, else none."""
    return F.when(test, F.array(*entries).cast(BLOCK_TYPE)).otherwise(no_blocks())


def blocks_of(entries: Column, make: Callable[[Column], Column]) -> Column:
    """One block per array entry."""
    return F.coalesce(F.transform(entries, make).cast(BLOCK_TYPE), no_blocks())


def no_blocks() -> Column:
    return F.array().cast(BLOCK_TYPE)


def fill(n: int, *stages: Column, taken: Column | None = None) -> Column:
    """Fold the stages into a list of at most ``n`` entries.

    A block adds its first products that are not on the list (nor in ``taken``)
    and is passed over once the list is full.
    """

    def add(picks: Column, b: Column) -> Column:
        seen = picks["product_id"]
        if taken is not None:
            seen = F.concat(seen, taken)
        more = F.transform(
            F.slice(F.array_except(b["ids"], seen), 1, b["take"]),
            lambda x: F.struct(
                x.alias("product_id"), b["priority"].alias("priority"), b["reason"].alias("reason")
            ),
        )
        return F.when(F.size(picks) < n, F.concat(picks, more)).otherwise(picks)

    return F.slice(F.aggregate(F.concat(*stages), F.array().cast(PICK_TYPE), add), 1, n)


def explode_recommendations(lists: DataFrame, products: DataFrame) -> DataFrame:
    """One row per recommendation with its rank and product columns.

    The outer form keeps the optimizer from testing each list's size first, which
    would build every list twice; the join drops the entry of an empty list.
    """
    rows = lists.select(
        "user_id", "strategy_used", F.posexplode_outer("recommendations").alias("_pos", "entry")
    ).select("user_id", "strategy_used", (F.col("_pos") + 1).cast("int").alias("rank"), "entry.*")
    goods = products.select("product_id", "name", "category", "price")
    return rows.join(goods, "product_id")
