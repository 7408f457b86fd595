"""Machine learning on behaviour tables: ALS, K-Means and their metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.ranking import top_n_per_group
from clickloom.operators.windows import list_rank
from clickloom.sources.session import checkpointed, require_checkpoint_dir

INT_MAX = 2_147_483_647
SPLIT_BUCKETS = 1000

# ALS settings of the batch job and the tuning grid
# (rank, iterations, regularisation).
ALS_ITERATIONS = 10
ALS_REGULARISATION = 0.1
SEED = 42
ALS_GRID = ((10, 10, 0.1), (50, 10, 0.01), (100, 15, 0.05), (150, 20, 0.1))
ALGORITHM = "collaborative_filtering_als"
MODEL_TYPE = "ALS_Collaborative_Filtering"

# Feature columns of the user clusters.
FEATURES = (
    "total_interactions",
    "unique_products_viewed",
    "categories_explored",
    "total_engagement_score",
    "avg_interaction_intensity",
    "active_days",
    "avg_hour_activity",
    "recent_engagement",
    "total_clicks",
    "total_views",
    "avg_product_price_viewed",
)
CLUSTER_RANGE = range(2, 8)

# Cluster types with their marketing strategy.
CLUSTER_TYPES = {
    "Power Users 💎": "VIP treatment, premium products, early access",
    "Active Explorers 🔍": "Product discovery, recommendations, variety",
    "Premium Shoppers 💰": "Luxury items, quality focus, exclusive offers",
    "Casual Browsers 👀": "Engagement campaigns, easy purchase flow",
    "New/Low Activity Users 🌱": "Onboarding, tutorials, attractive first offers",
}

# Weights of the hybrid blend.
HYBRID_WEIGHTS = {"cf": 0.4, "content": 0.3, "popularity": 0.2, "behavior": 0.1}


@dataclass(frozen=True)
class Split:
    train: DataFrame
    validation: DataFrame
    test: DataFrame


def split_ratings(
    ratings: DataFrame, validation: float = 0.0, test: float = 0.2, seed: int = SEED
) -> Split:
    """Train / validation / test parts by a hash of the pair.

    A pair falls in the same part whatever the partitioning or row order.
    """
    bucket = F.pmod(F.xxhash64("user_id", "product_id", F.lit(seed)), F.lit(SPLIT_BUCKETS))
    rows = ratings.withColumn("_bucket", bucket)
    low = round(test * SPLIT_BUCKETS)
    high = low + round(validation * SPLIT_BUCKETS)
    return Split(
        train=rows.filter(F.col("_bucket") >= high).drop("_bucket"),
        validation=rows.filter((F.col("_bucket") >= low) & (F.col("_bucket") < high)).drop("_bucket"),
        test=rows.filter(F.col("_bucket") < low).drop("_bucket"),
    )


def dense_index(ids: DataFrame) -> DataFrame:
    """``id`` and its place ``index`` (from 0) among the distinct ids in order.

    The ids are sorted over all partitions; a partition's rows are numbered
    where they are, and the sizes of the partitions before, a row each, are
    added. The sorted ids are checkpointed, so numbers and sizes come from the
    same partitions.
    """
    name = ids.columns[0]
    ordered = ids.where(F.col(name).isNotNull()).distinct().repartitionByRange(F.asc(name))
    ordered = ordered.sortWithinPartitions(name)
    placed = checkpointed(ordered.withColumn("_m", F.monotonically_increasing_id()))
    part, place = F.shiftright("_m", 33), F.col("_m").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = placed.withColumn("_own", part).join(offsets, F.col("_own") == F.col("_part"))
    return joined.select(name, (F.col("_before") + place).alias("index"))


def index_ids(ratings: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Dense integer indices for user and product ids, with the label tables.

    Any type of id goes the same way; rows with a NULL id get no index and drop
    out. More ids than an integer can number are an error.
    """
    labels: dict[str, DataFrame] = {}
    out = ratings
    for column, index in (("user_id", "user_index"), ("product_id", "product_index")):
        numbered = dense_index(ratings.select(column))
        if (numbered.agg(F.max("index")).first()[0] or 0) > INT_MAX:
            raise ValueError(f"more than {INT_MAX} different values of {column}")
        labels[column] = numbered.select(F.col("index").cast("int").alias(index), column)
        out = out.join(labels[column], column)
    return out, labels


def model_ids(ratings: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Integer indices for a model, with the label tables, as cheap as the ids allow.

    ALS needs integers, not dense ones: ids that an integer can hold are their
    own indices, and only the distinct ids are listed. Others are numbered by
    ``index_ids``. Rows with a NULL id drop out.
    """
    names = {"user_id": "user_index", "product_id": "product_index"}
    whole = [isinstance(ratings.schema[c].dataType, T.IntegralType) for c in names]
    if not all(whole):
        return index_ids(ratings)
    ends = [f(c).cast("bigint").alias(f"{f.__name__}_{c}") for c in names for f in (F.min, F.max)]
    found = ratings.agg(*ends).first()
    if any(x is not None and not -INT_MAX <= x <= INT_MAX for x in found):
        return index_ids(ratings)
    known = ratings.where(" and ".join(f"{c} is not null" for c in names))
    indices = {index: F.col(c).cast("int") for c, index in names.items()}
    labels = {c: known.select(indices[index].alias(index), c).distinct() for c, index in names.items()}
    return known.withColumns(indices), labels


def train_als(
    train: DataFrame,
    rating: str = "rating",
    rank: int = 10,
    iterations: int = ALS_ITERATIONS,
    regularisation: float = ALS_REGULARISATION,
    blocks: int | None = None,
) -> ALSModel:
    """Explicit ALS; ids the model has not seen get no prediction.

    The number of blocks is MLlib's default unless given. The factors are
    checkpointed, so the checkpoint folder is required.
    """
    require_checkpoint_dir(train.sparkSession)
    als = _als(rating, rank, iterations, regularisation, blocks)
    return als.fit(train.withColumn(rating, F.col(rating).cast("float")))


def _als(
    rating: str = "rating",
    rank: int = 10,
    iterations: int = ALS_ITERATIONS,
    regularisation: float = ALS_REGULARISATION,
    blocks: int | None = None,
) -> ALS:
    als = ALS(
        userCol="user_index",
        itemCol="product_index",
        ratingCol=rating,
        rank=rank,
        maxIter=iterations,
        regParam=regularisation,
        seed=SEED,
        coldStartStrategy="drop",
    )
    return als.setNumUserBlocks(blocks).setNumItemBlocks(blocks) if blocks else als


def als_grid(
    train: DataFrame,
    validation: DataFrame,
    grid: Sequence[tuple[int, int, float]] = ALS_GRID,
    blocks: int | None = None,
    parallel: int = 2,
) -> list[tuple[tuple[int, int, float], ALSModel, float | None]]:
    """Setting, model and validation RMSE of each ``(rank, iterations, regularisation)``, in grid order.

    ``parallel`` models are fitted at a time, so the small stages of one fill
    the gaps of another. The RMSE is None where no pair could be predicted.
    """
    require_checkpoint_dir(train.sparkSession)
    als = _als(blocks=blocks)
    maps = [{als.rank: r, als.maxIter: i, als.regParam: x} for r, i, x in grid]
    train = train.withColumn("rating", F.col("rating").cast("float")).persist(StorageLevel.MEMORY_AND_DISK)
    validation = validation.persist(StorageLevel.MEMORY_AND_DISK)
    fits = als.fitMultiple(train, maps)

    def fitted(_: int) -> tuple[int, ALSModel, float | None]:
        number, model = next(fits)
        return number, model, regression_metrics(model.transform(validation)).first()["rmse"]

    try:
        with ThreadPoolExecutor(parallel) as pool:
            found = sorted(pool.map(fitted, range(len(maps))), key=lambda f: f[0])
    finally:
        train.unpersist()
        validation.unpersist()
    return [(tuple(grid[k]), model, rmse) for k, model, rmse in found]


def tune_als(
    train: DataFrame,
    validation: DataFrame,
    grid: Sequence[tuple[int, int, float]] = ALS_GRID,
    blocks: int | None = None,
) -> tuple[ALSModel, tuple[int, int, float], float]:
    """The model of lowest validation RMSE over the grid; the first on a tie."""
    known = [f for f in als_grid(train, validation, grid, blocks) if f[2] is not None]
    if not known:
        raise ValueError("no validation pair could be predicted")
    setting, model, rmse = min(known, key=lambda f: f[2])
    return model, setting, rmse


def regression_metrics(
    predictions: DataFrame, label: str = "rating", prediction: str = "prediction"
) -> DataFrame:
    """RMSE, MAE and count over the rows that have a prediction, in one pass."""
    error = F.col(prediction).cast("double") - F.col(label).cast("double")
    rows = predictions.filter(F.col(prediction).isNotNull() & ~F.isnan(prediction))
    return rows.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.count("*").alias("total_predictions"),
    )


def coverage(
    test: DataFrame, predictions: DataFrame, user: str = "user_id", item: str = "product_id"
) -> DataFrame:
    """Share of test users and items that got a prediction, in percent.

    Users and items are reduced to one row each, with flags for the set they
    were seen in, before they are counted.
    """
    valid = predictions.filter(F.col("prediction").isNotNull())
    hit = F.col("_p") == 1

    def counts(column: str, name: str) -> DataFrame:
        tagged = test.select(column, F.lit(0).alias("_p")).unionByName(
            valid.select(column, F.lit(1).alias("_p"))
        )
        seen = tagged.where(F.col(column).isNotNull()).groupBy(column).agg(
            F.max(~hit).alias("_test"), F.max(hit).alias("_hit")
        )
        return seen.agg(
            F.struct(
                F.count_if("_test").alias(name), F.count_if("_hit").alias(f"predicted_{name}")
            ).alias("c")
        )

    stats = valid.agg(F.count("*").alias("total_predictions")).select(
        counts(user, "users").scalar().alias("u"), counts(item, "items").scalar().alias("i"), "total_predictions"
    ).select("u.*", "i.*", "total_predictions")
    percent = lambda a, b: F.when(
        F.col(b) > 0, F.round(F.col(a) / F.col(b) * 100, 2)
    ).otherwise(F.lit(0.0))
    return stats.select(
        percent("predicted_users", "users").alias("user_coverage_percent"),
        percent("predicted_items", "items").alias("item_coverage_percent"),
        "total_predictions",
    )


def cf_performance(test: DataFrame, predictions: DataFrame) -> DataFrame:
    """The stored performance document of a collaborative filtering run."""
    errors = regression_metrics(predictions).select(
        F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae")
    )
    one = errors.agg(F.first(F.struct("rmse", "mae")).alias("e"))
    return (
        coverage(test, predictions)
        .withColumn("_e", one.scalar())
        .select(
            "_e.rmse",
            "_e.mae",
            "user_coverage_percent",
            "item_coverage_percent",
            "total_predictions",
            F.lit(MODEL_TYPE).alias("model_type"),
        )
    )


def index_to_label(recs: DataFrame, labels: Mapping[str, DataFrame]) -> DataFrame:
    """Original ids for the indices in (user_index, product_index, ...) rows."""
    for column, index in (("product_id", "product_index"), ("user_id", "user_index")):
        if index in recs.columns:
            recs = recs.join(labels[column], index).drop(index)
    return recs


def recommend_for_all(
    model: ALSModel, labels: Mapping[str, DataFrame], as_of: str, n: int = 10
) -> DataFrame:
    """Top ``n`` products per user as ranked lists with original ids."""
    rows = list_rank(model.recommendForAllUsers(n)).withColumnRenamed("rating", "predicted_rating")
    entry = F.struct("rank", "product_id", "predicted_rating")
    out = index_to_label(rows, labels).groupBy("user_id").agg(
        F.array_sort(F.collect_list(entry)).alias("_list")
    )
    entries = F.transform(
        "_list",
        lambda e: F.struct(
            e["product_id"].alias("product_id"),
            e["predicted_rating"].alias("predicted_rating"),
            e["rank"].alias("rank"),
        ),
    )
    return out.select(
        "user_id",
        entries.alias("recommendations"),
        F.lit(ALGORITHM).alias("algorithm"),
        F.lit(str(as_of)).alias("generated_at"),
    )


def assemble_scale(features: DataFrame) -> tuple[DataFrame, PipelineModel]:
    """Feature vectors with mean 0 and standard deviation 1; NULLs count as 0.

    The features are checkpointed: the scaler and whatever uses the vectors
    read them there instead of building them again. They are cached before, which
    keeps the parts of the last shuffle: MLlib's starting centres depend on them.
    """
    ready = features.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURES})
    built = ready.persist(StorageLevel.MEMORY_AND_DISK)
    ready = checkpointed(built)
    built.unpersist()
    pipeline = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(FEATURES), outputCol="features_raw"),
            StandardScaler(
                inputCol="features_raw", outputCol="features", withMean=True, withStd=True
            ),
        ]
    )
    model = pipeline.fit(ready)
    return model.transform(ready), model


def silhouettes(rows: DataFrame) -> DataFrame:
    """``k, cluster, users, silhouette, mean_silhouette`` of (k, cluster, features) rows.

    ``features`` is an array of numbers; every ``k`` is a clustering of its own
    and all are scored together. With squared Euclidean distance the mean
    distance from a point to a cluster follows from the cluster's size, mean
    and mean square, so one aggregation gives all that a second pass over the
    rows needs: a few numbers for each cluster, never pairs of users. A user
    alone in a cluster, or with all others in the same one, has 0. An empty
    table has no rows.
    """
    dims = len(FEATURES)
    value = [F.element_at("features", i + 1) for i in range(dims)]
    square = sum((v * v for v in value[1:]), value[0] * value[0])
    points = rows.select("k", "cluster", "features", square.alias("_square"))
    parts = points.groupBy("k", "cluster").agg(
        F.count("*").alias("users"),
        F.avg("_square").alias("square"),
        F.array(*[F.avg(v) for v in value]).alias("mean"),
    )
    clusters = parts.groupBy("k").agg(
        F.collect_list(F.struct("cluster", "users", "square", "mean")).alias("_clusters")
    )

    def distance(part: Column) -> Column:
        product = sum((v * part["mean"][i] for i, v in enumerate(value[1:], 1)), value[0] * part["mean"][0])
        return F.greatest(F.col("_square") + part["square"] - 2 * product, F.lit(0.0))

    same = F.filter("_clusters", lambda c: c["cluster"] == F.col("cluster"))[0]
    others = F.filter("_clusters", lambda c: c["cluster"] != F.col("cluster"))
    met = points.join(clusters, "k").select(
        "k",
        "cluster",
        same["users"].alias("users"),
        (distance(same) * same["users"] / F.nullif(same["users"] - 1, F.lit(0))).alias("own"),
        F.array_min(F.transform(others, distance)).alias("next"),
    )
    widest = F.nullif(F.greatest("own", "next"), F.lit(0.0))
    score = F.when(F.col("own").isNotNull() & F.col("next").isNotNull(), (F.col("next") - F.col("own")) / widest)
    found = met.withColumn("score", F.coalesce(score, F.lit(0.0))).groupBy("k", "cluster").agg(
        F.count("*").alias("users"), F.sum("score").alias("total")
    )
    means = found.groupBy("k").agg((F.sum("total") / F.sum("users")).alias("mean_silhouette"))
    return found.join(means, "k").select(
        "k", "cluster", "users", (F.col("total") / F.col("users")).alias("silhouette"), "mean_silhouette"
    )


def kmeans_select_k(
    scaled: DataFrame, ks: Sequence[int] = tuple(CLUSTER_RANGE), iterations: int = 100
) -> tuple[KMeansModel, dict[int, float]]:
    """The K-Means model of best silhouette and the silhouette of each k, all scored in one job.

    The vectors are checkpointed, not cached as a table: only of a frame that
    is not cached does MLlib keep decoded vectors for its iterations.
    """
    data = checkpointed(scaled.select("user_id", "features"))
    models = {k: KMeans(k=k, seed=SEED, maxIter=iterations).fit(data) for k in ks}
    placed = data
    for k in ks:
        placed = models[k].copy().setPredictionCol(f"_{k}").transform(placed)
    choices = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"_{k}").alias("cluster")) for k in ks])
    placed = placed.select(vector_to_array("features").alias("features"), F.explode(choices).alias("_c"))
    found = silhouettes(placed.select("_c.k", "_c.cluster", "features"))
    scores = {r.k: r.mean_silhouette for r in found.select("k", "mean_silhouette").distinct().collect()}
    best = min(scores, key=lambda k: (-scores[k], k))
    return models[best], scores


def cluster_profile(assignments: DataFrame) -> DataFrame:
    """Size, averages and modal categories with their user counts per cluster.

    Categories are counted before they are listed, so the list is as long as the
    number of categories, not of users.
    """
    profile = assignments.groupBy("prediction").agg(
        F.count("*").alias("cluster_size"),
        F.avg("total_interactions").alias("avg_interactions"),
        F.avg("total_engagement_score").alias("avg_engagement"),
        F.avg("unique_products_viewed").alias("avg_unique_products"),
        F.avg("avg_product_price_viewed").alias("avg_price_preference"),
    )
    categories = (
        assignments.filter(F.col("most_viewed_category").isNotNull())
        .groupBy("prediction", "most_viewed_category")
        .agg(F.count("*").alias("n"))
        .groupBy("prediction")
        .agg(
            F.array_sort(
                F.collect_list(F.struct((-F.col("n")).alias("w"), F.col("most_viewed_category").alias("c")))
            ).alias("_c")
        )
        .select(
            "prediction",
            F.transform(
                "_c", lambda e: F.struct(e["c"].alias("category"), (-e["w"]).alias("users"))
            ).alias("top_categories"),
        )
    )
    return profile.join(categories, "prediction", "left").orderBy(
        F.desc("cluster_size"), "prediction"
    )


def cluster_type(
    engagement: Column,
    volume: Column,
    products: Column,
    price: Column,
    power: tuple[float, float] = (50, 20),
    explorer: tuple[float, float] = (20, 10),
    premium: float = 100_000,
    casual: tuple[float, float] = (10, 20),
) -> Column:
    """First matching cluster rule; a NULL average matches no rule."""
    names = list(CLUSTER_TYPES)
    return (
        F.when((engagement > power[0]) & (volume > power[1]), F.lit(names[0]))
        .when((engagement > explorer[0]) & (products > explorer[1]), F.lit(names[1]))
        .when(price > premium, F.lit(names[2]))
        .when((volume > casual[0]) & (engagement < casual[1]), F.lit(names[3]))
        .otherwise(F.lit(names[4]))
    )


def label_clusters(profile: DataFrame, **thresholds) -> DataFrame:
    """Type, marketing strategy and rounded averages per cluster."""
    kind = cluster_type(
        F.col("avg_engagement"),
        F.col("avg_interactions"),
        F.col("avg_unique_products"),
        F.col("avg_price_preference"),
        **thresholds,
    )
    strategy = F.create_map(*[F.lit(x) for pair in CLUSTER_TYPES.items() for x in pair])
    rows = profile.withColumn("type", kind)
    return rows.select(
        F.concat(F.lit("cluster_"), F.col("prediction")).alias("cluster"),
        "type",
        F.col("cluster_size").alias("size"),
        F.round("avg_interactions", 2).alias("avg_interactions"),
        F.round("avg_engagement", 2).alias("avg_engagement"),
        F.round("avg_unique_products", 2).alias("avg_products_viewed"),
        F.coalesce(F.round("avg_price_preference", 2), F.lit(0.0)).alias("avg_price_preference"),
        strategy[F.col("type")].alias("marketing_strategy"),
    )


def hybrid_blend(
    scores: DataFrame, weights: Mapping[str, float] = HYBRID_WEIGHTS, n: int = 10
) -> DataFrame:
    """Weighted blend of several sources, ``scores(user_id, product_id, source,
    score)``. Each source is scaled by the user's best score in it."""
    weight = F.lit(None).cast("double")
    for source, value in weights.items():
        weight = F.when(F.col("source") == source, F.lit(float(value))).otherwise(weight)
    known = scores.filter(F.col("source").isin(*weights) & (F.col("score") > 0))
    best = known.groupBy("user_id", "source").agg(F.max("score").alias("_best"))
    part = F.col("score") / F.col("_best") * weight
    blended = (
        known.join(best, ["user_id", "source"])
        .groupBy("user_id", "product_id")
        .agg(F.round(F.sum(part), 9).alias("score"))
    )
    return top_n_per_group(
        blended, ["user_id"], [F.desc("score"), F.asc("product_id")], n, spread_by="product_id"
    )
