"""Short product lists per category, and the lookup of a user's categories.

A recommender never joins users to products. Each category is cut to a short
ranked shelf first; a user then looks up the shelves of the few categories in
their profile (the slots) with one equi-join, and the list is put together from
these bounded arrays inside one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.joins import left_join_sparse

ID_TYPE = "array<bigint>"


def no_ids() -> Column:
    return F.array().cast(ID_TYPE)


def shelf(ranked: DataFrame, column: str, *extra: str) -> DataFrame:
    """(category, ordered product ids) from ranked products.

    With ``extra`` columns the entries are structs of product id and extras.
    """
    entry = F.struct("rank", "product_id", *extra)
    rows = ranked.groupBy("category").agg(F.array_sort(F.collect_list(entry)).alias("_e"))
    if not extra:
        return rows.select("category", F.col("_e.product_id").alias(column))
    return rows.select(
        "category",
        F.transform("_e", lambda e: F.struct(*[e[c].alias(c) for c in (*extra, "product_id")])).alias(
            column
        ),
    )


def look_up(
    users: DataFrame,
    slots: Mapping[str, Column],
    shelves: DataFrame,
    relations: DataFrame | None = None,
    related_of: Sequence[str] = (),
    n_related: int = 2,
) -> DataFrame:
    """Attach the shelf row of each slot's category as ``<slot>_shelf`` structs.

    The slots named in ``related_of`` also get ``<slot>_related``, the structs of
    their first ``n_related`` related categories in order; one without products
    keeps its place with a NULL shelf.

    ``users`` has one row per ``user_id``. Only ids, slots and categories go
    through the joins, empty slots left out; the other columns meet the result
    once, by the user.
    """
    entries = F.array(
        *[F.struct(F.lit(n).alias("slot"), c.alias("_category")) for n, c in slots.items()]
    )
    rows = users.select("user_id", F.inline(entries)).where("_category is not null")
    rows = rows.withColumn("_place", F.lit(0))
    if related_of:
        names = (
            relations.filter(F.col("rel_rank") <= n_related)
            .groupBy("category")
            .agg(
                F.array_sort(F.collect_list(F.struct("rel_rank", "related_category")))[
                    "related_category"
                ].alias("_names")
            )
        )
        rows = left_join_sparse(rows, names, "_category", "user_id", right_key="category")
        more = F.when(
            F.col("slot").isin(*related_of) & F.col("_names").isNotNull(),
            F.transform(
                "_names", lambda x, k: F.struct(x.alias("_category"), (k + 1).alias("_place"))
            ),
        ).otherwise(F.array().cast("array<struct<_category:string,_place:int>>"))
        own = F.array(F.struct("_category", "_place"))
        rows = rows.select("user_id", "slot", F.inline(F.concat(own, more)))
    columns = [c for c in shelves.columns if c != "category"]
    joined = left_join_sparse(rows, shelves, "_category", "user_id", right_key="category")
    found = F.struct(F.col("_category").alias("category"), *columns)
    own, related = F.col("_place") == 0, F.col("_place") > 0
    pick = lambda name: F.first(
        F.when((F.col("slot") == name) & own, found), ignorenulls=True
    )
    collect = lambda name: F.array_sort(
        F.collect_list(
            F.when((F.col("slot") == name) & related, F.struct("_place", found.alias("shelf")))
        )
    )["shelf"]
    looked = joined.groupBy("user_id").agg(
        *[pick(name).alias(f"{name}_shelf") for name in slots],
        *[collect(name).alias(f"{name}_related") for name in related_of],
    )
    found_columns = [*(f"{name}_shelf" for name in slots), *(f"{name}_related" for name in related_of)]
    whole = users.join(looked, "user_id", "left")
    nothing = {f"{n}_related": F.coalesce(f"{n}_related", F.array().cast(looked.schema[f"{n}_related"].dataType)) for n in related_of}
    return whole.withColumns(nothing).select(*users.columns, *found_columns) if nothing else whole
