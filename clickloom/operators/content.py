"""Content similarity of products from the words of their texts.

Products with the same words in the same category are one content, so copies
never meet pairwise. An index by word keeps the contents of largest weight at
its head and the others in levels of weight, each with its largest weight. Every
content first meets the heads of its words; the last entry of the list it gets
is a bound that a further content has to reach. What a level can reach at most
follows from its largest weight and from the largest weights of the content's
remaining words, so only levels and entries that can still enter a list are
read (max-score with block maxima). The lists are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.ranking import top_n_per_group
from clickloom.sources.session import checkpointed

DIGITS = 6
#: Levels of the index for a factor of two in weight, and their number.
LEVELS, MOST_LEVELS = 16, 480
#: What rounding in sums of products can add to a bound.
SLACK = 1e-9


def content_words(products: DataFrame, texts: Sequence[str] = ("name", "description")) -> DataFrame:
    """(product_id, category, words): lower-case words of the texts, sorted."""
    text = F.lower(F.concat_ws(" ", *texts))
    words = F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return products.filter(F.col("category").isNotNull()).select(
        "product_id", "category", F.array_sort(words).alias("words")
    ).filter(F.size("words") > 0)


def content_vectors(contents: DataFrame) -> DataFrame:
    """TF-IDF vector of each content, normalised, as (word, rarity, weight) rows.

    ``contents(content_id, category, words, copies)``; document frequency counts products.
    """
    words = contents.select(
        "content_id", "category", "copies", F.explode("words").alias("word")
    ).groupBy("content_id", "category", "copies", "word").agg(F.count("*").alias("tf"))
    frequency = words.groupBy("word").agg(F.sum("copies").alias("df"))
    total = contents.agg(F.sum("copies").alias("n"))
    idf = F.ln((total.scalar() + 1) / (F.col("df") + 1)) + 1
    weighted = words.join(frequency, "word").withColumn("raw", F.col("tf") * idf)
    # a content has as many rows here as words
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("content_id")))
    return weighted.select(
        "content_id", "category", "copies", "word", "df", (F.col("raw") / norm).alias("weight")
    )


def _level(weight: Column) -> Column:
    """Levels of falling weight; the last one has all that is smaller."""
    return F.least(F.floor(-F.log2(weight) * LEVELS), F.lit(MOST_LEVELS)).cast("int")


def _word_index(vectors: DataFrame, head: int) -> tuple[DataFrame, DataFrame]:
    """The ``head`` entries of largest weight of each word, and per word what the others can give.

    The second frame has ``top`` (largest weight), ``entries``, the last
    ``edge`` of the head and ``levels``: number, largest weight and least
    content of each level of further entries.
    """
    keys = ["category", "word"]
    first = top_n_per_group(
        vectors.select(*keys, "content_id", "weight"),
        keys,
        [F.desc("weight"), F.asc("content_id")],
        head,
        rank="_r",
        spread_by="content_id",
    )
    edges = first.groupBy(*keys).agg(
        F.max("weight").alias("top"),
        F.count("*").alias("entries"),
        F.min(F.struct(F.col("weight").alias("w"), (-F.col("content_id")).alias("c"))).alias("edge"),
    )
    further = vectors.join(edges, keys).where(_is_further())
    levels = further.groupBy(*keys, _level(F.col("weight")).alias("level")).agg(
        F.max("weight").alias("most"), F.min("content_id").alias("least")
    )
    levels = levels.groupBy(*keys).agg(F.collect_list(F.struct("level", "most", "least")).alias("levels"))
    return first.drop("_r"), edges.join(levels, keys, "left")


def _is_further() -> Column:
    """Whether an entry of a word comes after its head."""
    own = F.struct(F.col("weight").alias("w"), (-F.col("content_id")).alias("c"))
    return own < F.col("edge")


def _similarities(pairs: DataFrame, vectors: DataFrame, least: float) -> DataFrame:
    """``pairs(content_id, other)`` with ``similarity``, above 0 and at least ``least``."""
    vector = vectors.groupBy("content_id").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "weight"))).alias("vector")
    )
    others = vector.select(F.col("content_id").alias("other"), F.col("vector").alias("other_vector"))
    cosine = F.aggregate(
        F.map_entries("vector"),
        F.lit(0.0),
        lambda acc, e: acc
        + e["value"] * F.coalesce(F.try_element_at("other_vector", e["key"]), F.lit(0.0)),
    )
    near = pairs.join(vector, "content_id").join(others, "other")
    near = near.select(*pairs.columns, F.round(cosine, DIGITS).alias("similarity"))
    return near.filter((F.col("similarity") >= least) & (F.col("similarity") > 0))


def _further_pairs(vectors: DataFrame, words: DataFrame, limits: DataFrame, least: float) -> DataFrame:
    """``content_id, other, bound, worst``: entries behind the heads that can still enter the list of a content.

    ``limits(content_id, bound, worst)`` is the last entry of each full list. An
    entry enters above ``bound``, or at it with a smaller id than ``worst``.
    """
    rows = vectors.join(words, ["category", "word"]).join(limits, "content_id", "left")
    bound = F.greatest(F.coalesce("bound", F.lit(0.0)), F.lit(float(least)))
    # a word of one content alone gives nothing to another
    reach = F.when((F.col("entries") > 1) | F.col("levels").isNotNull(), F.col("weight") * F.col("top")).otherwise(0.0)
    rows = rows.withColumn("bound", bound).withColumn("worst", F.coalesce("worst", F.lit(2**63 - 1)))
    rows = rows.withColumn("_reach", reach)
    # a pair is found by its first common word in this order; the words after it add no more than _rest
    after = Window.partitionBy("content_id").orderBy(F.desc("_reach"), "word").rowsBetween(1, Window.unboundedFollowing)
    rest = F.least(F.sum("_reach").over(after), F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(after)))
    rows = rows.withColumn("_rest", F.coalesce(rest, F.lit(0.0)) + SLACK)
    rows = rows.where("levels is not null")

    def enters(weight: Column, other: Column) -> Column:
        return _is_better(F.round(F.col("weight") * weight + F.col("_rest"), DIGITS), other)

    hits = F.filter("levels", lambda e: enters(e["most"], e["least"]))
    seek = rows.withColumn("level", F.explode(F.transform(hits, lambda e: e["level"])))
    entries = vectors.join(words.select("category", "word", "edge"), ["category", "word"]).where(_is_further())
    entries = entries.select(
        "category", "word", _level(F.col("weight")).alias("level"),
        F.col("content_id").alias("other"), F.col("weight").alias("other_weight"),
    )
    pairs = seek.join(entries, ["category", "word", "level"]).where(F.col("content_id") != F.col("other"))
    pairs = pairs.where(enters(F.col("other_weight"), F.col("other")))
    return pairs.select("content_id", "other", "bound", "worst").distinct()


def _is_better(similarity: Column, other: Column) -> Column:
    """Whether ``other`` comes before the last entry of the list so far."""
    return (similarity > F.col("bound")) | ((similarity == F.col("bound")) & (other < F.col("worst")))


def content_similarity(
    products: DataFrame, n: int = 5, least: float = 0.0, texts: Sequence[str] = ("name", "description")
) -> DataFrame:
    """Up to ``n`` most similar products of the same category per product.

    Rounded cosine similarity of the words of ``texts``, above 0 and at least
    ``least``; ties go to the smaller id.
    """
    order = [F.desc("similarity"), F.asc("similar_id")]
    items = checkpointed(content_words(products, texts))
    contents = items.groupBy("category", "words").agg(
        F.count("*").alias("copies"), F.min("product_id").alias("content_id")
    )
    vectors = checkpointed(content_vectors(contents))
    # n + 1 products of each content are enough: at most one of them is the
    # product itself.
    owners = items.groupBy("category", "words").agg(F.min("product_id").alias("content_id"))
    placed = items.join(owners, ["category", "words"]).select("product_id", "content_id")
    shelf = checkpointed(top_n_per_group(
        placed, ["content_id"], [F.asc("product_id")], n + 1, rank="_r", spread_by="product_id"
    ).select(F.col("content_id").alias("other"), F.col("product_id").alias("similar_id")))
    head, words = _word_index(vectors, n + 1)
    words = checkpointed(words)
    pairs = vectors.select("category", "word", "content_id").join(
        head.select("category", "word", F.col("content_id").alias("other")), ["category", "word"]
    )
    pairs = pairs.where("content_id <> other").select("content_id", "other").distinct()
    same = owners.select("content_id", F.col("content_id").alias("other"), F.lit(1.0).alias("similarity"))
    # a content has n + 1 entries a word here, so its group needs no slices
    found = _similarities(pairs, vectors, least).unionByName(same).join(shelf, "other")
    near = checkpointed(top_n_per_group(found, ["content_id"], order, n + 1, rank="_rank"))
    limits = near.where(F.col("_rank") == n + 1).select(
        "content_id", F.col("similarity").alias("bound"), F.col("similar_id").alias("worst")
    )
    further = _similarities(_further_pairs(vectors, words, limits, least), vectors, least)
    further = further.where(_is_better(F.col("similarity"), F.col("other")))
    both = near.select("content_id", "similar_id", "similarity").unionByName(
        further.join(shelf, "other").select("content_id", "similar_id", "similarity")
    )
    # a content may be found at a head and again behind another one
    best = top_n_per_group(both.distinct(), ["content_id"], order, n + 1, rank="_rank", spread_by="similar_id")
    lists = best.groupBy("content_id").agg(
        F.array_sort(F.collect_list(F.struct("_rank", "similar_id", "similarity"))).alias("_l")
    )
    others = F.filter("_l", lambda e: e["similar_id"] != F.col("product_id"))
    return (
        placed.join(lists, "content_id")
        .select("product_id", F.posexplode(F.slice(others, 1, n)).alias("_pos", "e"))
        .select("product_id", (F.col("_pos") + 1).cast("int").alias("rank"), "e.similar_id", "e.similarity")
    )
