"""The hybrid recommender: four sources of scores for one blend.

Behaviour and content name few products for a user and are scored as they are.
Predictions and popularity concern every product, so the best sums of these two
are found by a threshold algorithm: products lie in blocks, each with what a
source can give at most there, and a user reads the blocks of largest bound
first and then only those whose bound reaches the list so far.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.ranking import top_n_per_group
from clickloom.functions.times import AsOf
from clickloom.operators import aggregates, content, ml
from clickloom.sources.session import checkpointed

#: Products of a block at least, users that meet a block in one task, and scores in memory.
BLOCK, TOGETHER, SCORES = 256, 4096, 4_000_000
#: Directions of factors that blocks are formed around, at most.
DIRECTIONS = 1024
#: Blocks that a user reads before there is a bound.
FIRST = 2
#: Digits of a blended score, and what rounding can take from a bound.
DIGITS, SLACK = 9, 1e-8


def behaviour_scores(interactions: DataFrame, products: DataFrame) -> DataFrame:
    """(user_id, product_id, score) of what users did, products with a category only."""
    pairs = aggregates.user_product_scores(interactions, products).where("category is not null")
    return pairs.select("user_id", "product_id", F.col("total_score").cast("double").alias("score"))


def content_scores(behaviour: DataFrame, similar: DataFrame) -> DataFrame:
    """Products similar to those a user likes, weighted by liking times similarity.

    Every product of positive score takes part with its short list of
    ``similar(product_id, similar_id, similarity)``.
    """
    best = behaviour.where("score > 0 and user_id is not null")
    # scores are whole and similarities have six digits, so the sums are exact
    points = F.sum(F.col("score").cast("decimal(18,0)") * F.col("similarity").cast("decimal(10,6)"))
    return (
        best.select("user_id", "product_id", "score")
        .join(similar.select("product_id", "similar_id", "similarity"), "product_id")
        .groupBy("user_id", F.col("similar_id").alias("product_id"))
        .agg(points.cast("double").alias("score"))
    )


def popularity_scores(interactions: DataFrame, products: DataFrame) -> DataFrame:
    """(product_id, score): interactions of each known product."""
    sold = interactions.where("product_id is not null").join(products.select("product_id"), "product_id", "left_semi")
    return sold.groupBy("product_id").agg(F.count("*").cast("double").alias("score"))


def sources(interactions: DataFrame, products: DataFrame, similar: DataFrame) -> DataFrame:
    """``(user_id, product_id, source, score)`` of the sources that need no model.

    Popularity is the same for all users: its rows have no user.
    """
    behaviour = behaviour_scores(interactions, products)
    popular = popularity_scores(interactions, products).select(F.lit(None).cast("bigint").alias("user_id"), "product_id", "score")
    return (
        behaviour.withColumn("source", F.lit("behavior"))
        .unionByName(content_scores(behaviour, similar).withColumn("source", F.lit("content")))
        .unionByName(popular.withColumn("source", F.lit("popularity")))
    )


def collaborative_model(interactions: DataFrame) -> tuple[ALSModel, dict[str, DataFrame]]:
    """ALS model of the implicit ratings, with the label tables of its indices."""
    ratings, labels = ml.model_ids(aggregates.implicit_ratings(interactions))
    return ml.train_als(ratings), labels


def model_factors(model: ALSModel, labels: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``(user_id, features)`` and ``(product_id, features)`` of a model, in doubles."""
    wide = F.transform("features", lambda x: x.cast("double")).alias("features")
    users = model.userFactors.join(labels["user_id"].withColumnRenamed("user_index", "id"), "id")
    goods = model.itemFactors.join(labels["product_id"].withColumnRenamed("product_index", "id"), "id")
    return users.select("user_id", wide), goods.select("product_id", wide)


# ------------------------------------------------------- best products by bounds


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(values.flatten()).reshape(len(values), -1)


def product_blocks(goods: DataFrame) -> DataFrame:
    """``goods(product_id, features, share)`` with ``block``.

    A product goes to the nearest of at most ``DIRECTIONS`` others, chosen by a
    hash of their ids; a direction with many products is cut by another hash.
    There are at most ``5 * DIRECTIONS`` blocks.
    """
    n = goods.count()
    some = goods.orderBy(F.xxhash64("product_id"), "product_id").limit(min(DIRECTIONS, n // BLOCK + 1))
    pivots = np.array([r.features for r in some.select("features").collect()])
    if not len(pivots):
        return goods.withColumn("block", F.lit(0).cast("bigint"))
    columns = f"product_id {goods.schema['product_id'].dataType.simpleString()}, features array<double>, share double"
    lengths = (pivots * pivots).sum(axis=1)

    def nearest(batches):
        for got in batches:
            vectors = _matrix(got.column(1))
            distance = lengths - 2 * vectors @ pivots.T
            yield pa.RecordBatch.from_arrays(
                [*got.columns, pa.array(distance.argmin(axis=1), pa.int64())], names=[*got.schema.names, "direction"]
            )

    rows = goods.select("product_id", "features", "share").mapInArrow(nearest, columns + ", direction bigint")
    rows = checkpointed(rows)
    size = max(BLOCK, n // (4 * DIRECTIONS))
    parts = rows.groupBy("direction").agg(F.ceil(F.count("*") / size).alias("_parts"))
    piece = F.pmod(F.xxhash64("product_id"), F.col("_parts"))
    # a number of directions is a bound for the hash of the piece
    block = F.col("direction") + piece * F.lit(len(pivots))
    return rows.join(F.broadcast(parts), "direction").select("product_id", "features", "share", block.alias("block"))


class Bounds:
    """What the sources can give at most in each block: near a centre, within a radius, below a popularity."""

    def __init__(self, goods: DataFrame) -> None:
        size = len((goods.select("features").first() or [[]])[0])
        means = goods.groupBy("block").agg(
            F.array(*(F.avg(F.col("features")[k]) for k in range(size))).alias("centre"),
            F.max("share").alias("share"), F.count("*").alias("n"),
        )
        length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x * x))
        gap = F.zip_with("features", "centre", lambda x, y: x - y)
        far = F.sqrt(F.aggregate(gap, F.lit(0.0), lambda a, x: a + x * x))
        rows = goods.select("block", "features").join(means, "block").groupBy("block", "centre", "share", "n")
        table = rows.agg(F.max(far).alias("radius"), F.max(length).alias("length")).orderBy("block").collect()
        column = lambda c: np.array([r[c] for r in table], float)
        self.blocks = np.array([r.block for r in table], np.int64)
        self.sizes = np.array([r.n for r in table], np.int64)
        self.centres = np.array([r.centre for r in table], float).reshape(len(table), size)
        self.radii, self.lengths, self.shares = column("radius"), column("length"), column("share")

    def __call__(self, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The largest score of each user (row) in each block."""
        own = np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        predicted = np.minimum(vectors @ self.centres.T + own * self.radii, own * self.lengths)
        return predicted + weights[:, None] * self.shares


def _scored(wanted: DataFrame, goods: DataFrame, n: int, parts: int) -> DataFrame:
    """``user_id, product_id, score``: the ``n`` best products of each wanted pair of user and block."""
    types = {c: f.schema[c].dataType.simpleString() for f, c in ((wanted, "user_id"), (goods, "product_id"))}
    wanted = wanted.withColumn("part", F.pmod(F.xxhash64("user_id"), F.lit(parts)))
    needed = wanted.select(F.col("block").alias("_block"), F.col("part").alias("_part")).distinct()
    needed = needed.join(goods, F.col("_block") == F.col("block")).select("_block", "_part", "product_id", "features", "share")

    def best(key, users: pa.Table, items: pa.Table) -> pa.Table:
        names = ["user_id", "product_id", "score"]
        kinds = [users.schema.field("user_id").type, items.schema.field("product_id").type, pa.float64()]
        if not len(users) or not len(items):
            return pa.Table.from_arrays([pa.array([], k) for k in kinds], names=names)
        items = items.sort_by("product_id")  # the lesser product first where scores are equal
        vectors, weights = _matrix(users["features"]), users["weight"].to_numpy()
        others, shares = _matrix(items["features"]).T, items["share"].to_numpy()
        step, found = max(1, SCORES // len(items)), []
        for start in range(0, len(users), step):
            own = slice(start, start + step)
            scores = np.round(vectors[own] @ others + np.outer(weights[own], shares), DIGITS)
            first = np.argsort(-scores, axis=1, kind="stable")[:, :n]
            owner = start + np.repeat(np.arange(len(scores)), first.shape[1])
            found.append((owner, first.ravel(), np.take_along_axis(scores, first, 1).ravel()))
        owner, first, scores = (np.concatenate(x) for x in zip(*found, strict=True))
        columns = [users["user_id"].take(pa.array(owner)), items["product_id"].take(pa.array(first)), pa.array(scores)]
        return pa.Table.from_arrays(columns, names=names)

    grouped = wanted.groupBy("block", "part").cogroup(needed.groupBy("_block", "_part"))
    return grouped.applyInArrow(best, f"user_id {types['user_id']}, product_id {types['product_id']}, score double")


def best_products(users: DataFrame, goods: DataFrame, n: int, bounds: Bounds | None = None) -> DataFrame:
    """``user_id, product_id, score, rank``: the ``n`` largest sums of prediction and weighted share.

    ``users(user_id, features, weight)`` and ``goods(product_id, features,
    share, block)``; the score is the scalar product of the features and
    ``weight * share``. A user reads the ``FIRST`` blocks of largest bound, or as
    many as have ``n`` products; the
    score of the last place reached there is a threshold, and of the other
    blocks only those whose bound reaches it are read. What no block's bound
    reaches cannot enter the list, so it is that of all pairs.
    """
    bounds = bounds or Bounds(goods)
    if not len(bounds.blocks):
        kind = goods.schema["product_id"].dataType.simpleString()
        return users.select("user_id", F.lit(None).cast(kind).alias("product_id"), F.lit(0.0).alias("score"), F.lit(1).alias("rank")).limit(0)
    shared = users.sparkSession.sparkContext.broadcast(bounds)
    kind = users.schema["user_id"].dataType.simpleString()
    columns = f"user_id {kind}, features array<double>, weight double, block bigint"

    def blocks(further: bool):
        def run(batches):
            own = shared.value
            for got in batches:
                for start in range(0, got.num_rows, 1024):
                    some = got.slice(start, 1024)
                    most = own(_matrix(some.column("features")), some.column("weight").to_numpy())
                    order = np.argsort(-most, axis=1, kind="stable")
                    before = own.sizes[order].cumsum(axis=1) - own.sizes[order]
                    read = np.zeros(most.shape, bool)
                    np.put_along_axis(read, order, (before < n) | (np.arange(most.shape[1]) < FIRST), axis=1)
                    if further:
                        least = some.column("least").to_numpy(zero_copy_only=False)[:, None]
                        read = ~read & ~(most < least - SLACK)
                    row, block = np.nonzero(read)
                    kept = some.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [*(kept.column(c) for c in ("user_id", "features", "weight")), pa.array(own.blocks[block])],
                        names=["user_id", "features", "weight", "block"],
                    )

        return run

    parts = max(1, users.count() // TOGETHER)
    rows = users.select("user_id", "features", "weight")
    order = [F.desc("score"), F.asc("product_id")]
    near = checkpointed(top_n_per_group(_scored(rows.mapInArrow(blocks(False), columns), goods, n, parts), ["user_id"], order, n))
    least = near.where(F.col("rank") == n).select("user_id", F.col("score").alias("least"))
    rows = rows.join(least, "user_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    more = _scored(rows.mapInArrow(blocks(True), columns), goods, n, parts)
    both = near.drop("rank").unionByName(more)
    return top_n_per_group(both, ["user_id"], order, n)


def recommend_hybrid(
    interactions: DataFrame,
    products: DataFrame,
    n: int = 10,
    similar: DataFrame | None = None,
    factors: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Blended lists of predictions, content, popularity and behaviour.

    ``factors`` are ``(user_id, features)`` and ``(product_id, features)`` whose
    scalar product is the prediction; without them an ALS model of the implicit
    ratings is fitted. The lists are those of scoring every user with every
    product: a product that behaviour or content names is scored in all
    sources. Of the others, which have a prediction and popularity only, ``n``
    by the sum of both and ``n`` by popularity, where a prediction is not
    positive, are enough. A user's best prediction and the most popular product
    are among these, so the blend scales by the best of all products.
    """
    weights = ml.HYBRID_WEIGHTS
    if similar is None:
        similar = content.content_similarity(products)
    if factors is None:
        factors = model_factors(*collaborative_model(interactions))
    user_factors, product_factors = (checkpointed(f) for f in factors)
    # each is used several times; with their plans inside, that of the blend would outgrow the driver
    behaviour = checkpointed(behaviour_scores(interactions, products))
    alike = checkpointed(content_scores(behaviour, similar))
    counts = checkpointed(popularity_scores(interactions, products))
    most = counts.agg(F.max("score")).first()[0] or 1.0
    share = F.coalesce(F.col("score"), F.lit(0.0)) / F.lit(most)
    goods = product_factors.join(counts, "product_id", "left").select("product_id", "features", share.alias("share"))
    goods = checkpointed(product_blocks(goods))
    bounds = Bounds(goods)
    top = checkpointed(best_products(user_factors.withColumn("weight", F.lit(0.0)), goods, 1, bounds))
    scale = F.lit(weights["cf"]) / F.col("score")
    scaled = user_factors.join(top.where("score > 0").select("user_id", "score"), "user_id")
    scaled = scaled.select("user_id", F.transform("features", lambda x: x * scale).alias("features"))
    sums = best_products(scaled.withColumn("weight", F.lit(weights["popularity"])), goods, n, bounds)
    sold = interactions.join(counts.select("product_id"), "product_id", "left_semi")
    users = sold.select("user_id").unionByName(top.select("user_id")).where("user_id is not null").distinct()
    bestsellers = counts.orderBy(F.desc("score"), F.asc("product_id")).limit(n).select("product_id")
    pair = ["user_id", "product_id"]
    pairs = behaviour.select(pair).unionByName(alike.select(pair)).unionByName(top.select(pair))
    pairs = pairs.unionByName(sums.select(pair)).unionByName(users.crossJoin(bestsellers))
    pairs = checkpointed(pairs.where("user_id is not null").distinct())
    predicted = pairs.join(user_factors, "user_id").join(
        product_factors.withColumnRenamed("features", "other"), "product_id"
    )
    products_of = F.zip_with("features", "other", lambda x, y: x * y)
    predicted = predicted.select(*pair, F.aggregate(products_of, F.lit(0.0), lambda a, x: a + x).alias("score"))
    parts = {"behavior": behaviour, "content": alike, "cf": predicted, "popularity": pairs.join(counts, "product_id")}
    scores = None
    for source, rows in parts.items():
        rows = rows.select(*pair, "score", F.lit(source).alias("source"))
        scores = rows if scores is None else scores.unionByName(rows)
    return ml.hybrid_blend(scores, n=n)
