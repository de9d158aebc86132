"""Recommender: training, scoring, re-ranking and fallbacks.

Candidates are long frames (user_id, pos, product_id, score), ``pos`` from 0, bounded per user by the candidate
count; finished lists are (user_id, rec_items array).
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.functions import scores
from cartwheel.functions.text import split_ids
from cartwheel.operators import features, ranking, search, vectors
from cartwheel.plans.skew import number_in_group
from cartwheel.session import scratch, shared_dir, ship_package

# Training and re-ranking parameters.
RANK, REG, ALPHA, ITERATIONS = 64, 0.01, 40.0, 10
COUNT_RANK, COUNT_ITERATIONS = 50, 15
GAMMA, MMR_LAMBDA, CANDIDATES, TOP_K = 0.3, 0.3, 15, 10
PREFERENCE_SHOWN = 5
#: Factors of the other side that a task of the training holds at most, in bytes, and what one takes beside its numbers.
FACTOR_BYTES, FACTOR_OBJECT = 320 << 20, 24


# -- training and scoring ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Recommender:
    """A trained model with the dense numbers that it knows users (user_id, u) and products (product_id, i) by."""

    model: ALSModel
    users: DataFrame
    products: DataFrame


def _numbered(df: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct ids of any size with numbers from 0 that fit the trainer's 32 bits; written once."""
    spark = df.sparkSession
    ids = df.select(F.col(key).cast("long").alias(key)).distinct()
    numbered = number_in_group(ids.withColumn("_all", F.lit(0)), ["_all"], [key])
    path = scratch(spark, f"numbered-{key}")
    numbered.select(key, (F.col("rn") - 1).cast("int").alias(name)).write.parquet(path)
    return spark.read.parquet(path)


def _most_met(ratings: int, others: int, blocks: int) -> float:
    """How many of ``others`` have a rating in one of ``blocks`` blocks, if the ratings lie evenly."""
    return others * -math.expm1(math.log1p(-1 / blocks) * ratings / others)


def training_blocks(ratings: int, users: int, products: int, rank: int, parallelism: int) -> tuple[int, int]:
    """Numbers of user and of product blocks for the training.

    A task takes one block and holds the factors of all on the other side that have a rating in it, so blocks must grow
    with the ratings, until those factors and the block's own take ``FACTOR_BYTES`` at most. Every further block
    is sent more copies of a factor, so there are no more of them than that. A few ratings have a block for each core
    and 10 at least.
    """
    size, found = 4 * rank + FACTOR_OBJECT, []
    for own, others in ((users, products), (products, users)):
        blocks = max(10, parallelism)
        while blocks < own and size * (_most_met(ratings, others, blocks) + own / blocks) > FACTOR_BYTES:
            blocks += max(1, blocks // 16)
        found.append(blocks)
    return found[0], found[1]


def train_als(
    ratings: DataFrame,
    rank: int = RANK,
    reg: float = REG,
    alpha: float = ALPHA,
    iters: int = ITERATIONS,
    seed: int = 42,
    blocks: int | None = None,
    value: str = "rating",
) -> tuple[Recommender, dict]:
    """Implicit, non-negative ALS on the highest rating per user and product; returns the model and its metadata.

    Ids may have 64 bits; the trainer sees dense numbers. ``blocks`` sets the number of user and item blocks (default:
    ``training_blocks``). Factors are checkpointed to the shared folder in every iteration.
    """
    spark = ratings.sparkSession
    shared_dir(spark)
    # Training passes over the ratings many times.
    deduped = features.dedupe_ratings(ratings, value).checkpoint()
    stats = features.check_ratings(deduped)
    users, products = _numbered(deduped, "user_id", "u"), _numbered(deduped, "product_id", "i")
    user_blocks, item_blocks = (blocks, blocks) if blocks else training_blocks(
        stats["cnt"], users.count(), products.count(), rank, spark.sparkContext.defaultParallelism
    )
    als = ALS(
        userCol="u",
        itemCol="i",
        ratingCol="rating",
        rank=rank,
        regParam=reg,
        alpha=alpha,
        maxIter=iters,
        implicitPrefs=True,
        nonnegative=True,
        coldStartStrategy="drop",
        seed=seed,
        numUserBlocks=user_blocks,
        numItemBlocks=item_blocks,
        # Each checkpoint lets the trainer drop the shuffle files of the iteration before; values stay the same.
        checkpointInterval=1,
    )
    dense = deduped.join(users, "user_id").join(products, "product_id").select("u", "i", "rating")
    trained = Recommender(als.fit(dense), users, products)
    return trained, {**stats, "rank": rank, "reg": reg, "alpha": alpha, "iters": iters, "seed": seed}


def train_als_counts(
    counts: DataFrame, rank: int = COUNT_RANK, reg: float = REG, iters: int = COUNT_ITERATIONS, seed: int = 42
) -> tuple[Recommender, dict]:
    """The same model on raw purchase counts."""
    return train_als(counts, rank=rank, reg=reg, alpha=1.0, iters=iters, seed=seed, value="times_purchased")


def save_model(trained: Recommender, metadata: dict, path: str) -> None:
    """Write the model, its id tables and its metadata below ``path``."""
    spark = trained.users.sparkSession
    trained.model.write().overwrite().save(f"{path}/model")
    trained.users.write.mode("overwrite").parquet(f"{path}/users")
    trained.products.write.mode("overwrite").parquet(f"{path}/products")
    spark.range(1).select(F.lit(json.dumps(metadata)).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_model(spark: SparkSession, path: str) -> tuple[Recommender, dict]:
    """What ``save_model`` wrote, for scoring in batches."""
    metadata = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    users, products = (spark.read.parquet(f"{path}/{name}") for name in ("users", "products"))
    return Recommender(ALSModel.load(f"{path}/model"), users, products), metadata


def _factors(trained: Recommender) -> tuple[DataFrame, DataFrame]:
    """Factors of users and products as (id, vector) of their dense numbers."""
    model = trained.model
    return tuple(f.select(F.col("id").cast("long").alias("id"), F.col("features").alias("vector")) for f in (model.userFactors, model.itemFactors))


def _best(trained: Recommender, users: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Long rows (user_id, pos, product_id, score): the ``k`` products with the largest inner product of each user."""
    found = vectors.largest_products(items, users, k).found
    rows = found.select(F.col("query_id").alias("u"), (F.col("rank") - 1).alias("pos"), F.col("id").alias("i"), "score")
    return rows.join(trained.users, "u").join(trained.products, "i").select("user_id", "pos", "product_id", "score")


def all_candidates(trained: Recommender, k: int) -> DataFrame:
    """Top ``k`` products of every user as candidate rows. Products are met in the order of their norms, and a user
    stops where the norms left cannot reach its k-th score (``vectors.largest_products``)."""
    users, items = _factors(trained)
    return _best(trained, users, items, k)


def recommend_all(trained: Recommender, k: int) -> DataFrame:
    """Top ``k`` products of every user as one list."""
    return to_lists(all_candidates(trained, k), "pos")


def recommend_subset(trained: Recommender, users: DataFrame, k: int) -> DataFrame:
    """Top ``k`` products of the given users, one row each with its ``pos``; users the model does not know have none."""
    wanted = users.select(F.col("user_id").cast("long").alias("user_id")).distinct()
    known = wanted.join(trained.users, "user_id").select(F.col("u").cast("long").alias("id"))
    factors, items = _factors(trained)
    return _best(trained, factors.join(known, "id"), items, k)


def score_pairs(trained: Recommender, pairs: DataFrame, bounds: tuple[float, float] = scores.MODEL_BOUNDS) -> DataFrame:
    """Raw and normalised score of user and product pairs; unknown pairs score 0."""
    keep_unknown = trained.model.copy().setColdStartStrategy("nan")
    typed = pairs.withColumns({c: F.col(c).cast("long") for c in ("user_id", "product_id")})
    dense = typed.join(trained.users, "user_id", "left").join(trained.products, "product_id", "left").na.fill(-1, ["u", "i"])
    raw = F.coalesce(F.nanvl(F.col("prediction").cast("double"), F.lit(0.0)), F.lit(0.0))
    return keep_unknown.transform(dense).select(
        "user_id",
        "product_id",
        F.round(raw, 3).alias("score"),
        F.round(scores.normalize(raw, bounds), 3).alias("normalized_score"),
    )


def item_vectors(trained: Recommender) -> DataFrame:
    factors = trained.model.itemFactors.withColumnRenamed("id", "i")
    return factors.join(trained.products, "i").select("product_id", F.col("features").alias("vector"))


def user_vectors(trained: Recommender) -> DataFrame:
    factors = trained.model.userFactors.withColumnRenamed("id", "u")
    return factors.join(trained.users, "u").select(F.col("user_id").alias("id"), F.col("features").alias("vector"))


def similar_users(known: DataFrame | vectors.Index, users: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` users closest (cosine) to each of ``users`` (user_id), the user left out.

    ``known`` holds the vectors (id, vector) of all users, or is their index; one that is kept serves many calls.
    """
    index = known if isinstance(known, vectors.Index) else vectors.build_index(known)
    wanted = index.vectors.join(users.select(F.col("user_id").cast("long").alias("id")).distinct(), "id", "left_semi")
    return vectors.search(index, wanted, n, exclude_self=True).found.select(
        F.col("query_id").alias("user_id"), F.col("id").alias("similar_user_id"), "similarity", "rank"
    )


def popular_by_norm(vectors: DataFrame, n: int = 10) -> DataFrame:
    """Products with the longest factor vectors, a stand-in for popularity."""
    lengths = vectors.select("product_id", scores.norm(F.col("vector")).alias("norm"))
    return lengths.select(
        "product_id", "norm", F.round(scores.normalize(F.col("norm")), 3).alias("normalized")
    ).orderBy(F.desc("norm"), "product_id").limit(n)


def score_ranges(df: DataFrame, column: str, kind: str) -> DataFrame:
    x = F.col(column).cast("double")
    return df.agg(
        F.lit(kind).alias("kind"),
        F.min(x).alias("min_score"),
        F.max(x).alias("max_score"),
        F.avg(x).alias("mean_score"),
        F.stddev_pop(x).alias("std_score"),
        (F.max(x) - F.min(x)).alias("range_score"),
    )


# -- re-ranking --------------------------------------------------------------------------------------------------


def popularity_z(lines: DataFrame) -> DataFrame:
    """Standardised log popularity per product; 0 for all when it does not vary."""
    logs = lines.groupBy("product_id").agg(F.log1p(F.count(F.lit(1)).cast("double")).alias("logc"))
    stats = logs.agg(F.avg("logc").alias("mu"), F.stddev_samp("logc").alias("sig")).select(F.struct("*")).scalar()
    z = F.when(stats["sig"] > 0, (F.col("logc") - stats["mu"]) / stats["sig"]).otherwise(F.lit(0.0))
    return logs.select("product_id", z.alias("pop_z"))


def filter_seen(recs: DataFrame, seen: DataFrame) -> DataFrame:
    """Drop candidates the user already has; ``seen`` is (user_id, product_id), users without rows have seen nothing."""
    return recs.join(seen.select("user_id", "product_id"), ["user_id", "product_id"], "left_anti").select(*recs.columns)


def blend(recs: DataFrame, pop_z: DataFrame, gamma: float = GAMMA) -> DataFrame:
    """Mix each user's standardised scores with product popularity; adds ``base`` and ``rank`` (ties by product id)."""
    user = Window.partitionBy("user_id")
    spread = F.stddev_pop("score").over(user)
    z = F.when(spread > 0, (F.col("score") - F.avg("score").over(user)) / spread).otherwise(F.lit(0.0))
    mixed = (
        recs.join(pop_z, "product_id", "left")
        .withColumn("base", (1 - gamma) * z + gamma * F.coalesce("pop_z", F.lit(0.0)))
        .withColumn("rank", F.row_number().over(user.orderBy(F.desc("base"), "product_id")))
    )
    return mixed.select("user_id", "pos", "product_id", "score", "base", "rank")


def to_lists(ranked: DataFrame, order: str = "rank") -> DataFrame:
    """One list per user from candidate rows (bounded by the candidate count)."""
    rows = ranked.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct(order, "product_id"))).alias("_r"))
    return rows.select("user_id", F.transform("_r", lambda x: x["product_id"]).alias("rec_items"))


def _greedy(base: np.ndarray, there: np.ndarray, vectors: np.ndarray, k: int, lam: float) -> np.ndarray:
    """Places of all users' candidates in selection order, the unselected behind in their given order, padding last.

    ``base`` and ``there`` (no padding) are users x candidates, ``vectors`` users x candidates x dimensions, zero where
    a vector is unknown. Each greedy step is one array operation over all users.
    """
    users, n = base.shape
    length = np.linalg.norm(vectors, axis=2, keepdims=True)
    unit = np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)
    similar = np.maximum(unit @ unit.transpose(0, 2, 1), 0.0)
    step = np.where(there, k + np.arange(n), k + 2 * n)
    closest, free, row = np.zeros((users, n)), there.copy(), np.arange(users)
    for i in range(min(k, n)):
        value = base if i == 0 else lam * base - (1.0 - lam) * closest
        best = np.where(free, value, -np.inf).argmax(1)
        more = free[row, best]
        step[row[more], best[more]] = i
        free[row, best] = False
        closest = np.maximum(closest, similar[row, best])
    return np.argsort(step, axis=1, kind="stable")


def mmr(
    recs: DataFrame, vectors: DataFrame, lam: float = MMR_LAMBDA, k: int = TOP_K, partitions: int | None = None
) -> DataFrame:
    """Greedy diverse re-ranking of the blended candidates; ``vectors`` is (product_id, vector).

    Vectors are joined to the candidates, not sent to every task. A user's candidates form one row, and whole batches
    of users go through the greedy choice at once. Users are spread over ``partitions`` (default: the shuffle
    partitions) unless they are grouped by user already: sized by bytes alone, they would end up in too few tasks.
    """
    ship_package(recs.sparkSession)
    n = partitions or int(recs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = recs.join(vectors, "product_id", "left").repartition(n, "user_id")
    row = F.struct("pos", "product_id", "base", "vector")
    grouped = placed.groupBy("user_id").agg(F.sort_array(F.collect_list(row)).alias("c"))
    users = grouped.select(
        "user_id",
        "c.product_id",
        F.transform("c.base", lambda b: b.cast("double")).alias("base"),
        F.transform("c.vector", lambda v: F.coalesce(F.size(v), F.lit(0))).alias("sizes"),
        F.flatten(F.array_compact("c.vector")).cast("array<double>").alias("flat"),
    )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                items = part.column("product_id")
                counts = np.diff(items.offsets.to_numpy())
                there = np.arange(counts.max(initial=0)) < counts[:, None]
                sizes = part.column("sizes").flatten().to_numpy()
                values = part.column("flat").flatten().to_numpy()
                base, ids = np.zeros(there.shape), np.zeros(there.shape, np.int64)
                base[there] = part.column("base").flatten().to_numpy()
                ids[there] = items.flatten().to_numpy()
                known = np.zeros((len(sizes), sizes.max(initial=1)))
                known[sizes > 0] = values.reshape(-1, known.shape[1])
                matrix = np.zeros((*there.shape, known.shape[1]))
                matrix[there] = known
                order = _greedy(base, there, matrix, k, lam)
                listed = np.take_along_axis(ids, order, 1)[there]
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(listed))
                yield pa.RecordBatch.from_arrays([part.column("user_id"), lists], names=["user_id", "rec_items"])

    return users.select(F.col("user_id").cast("long").alias("user_id"), F.col("product_id").cast("array<long>").alias("product_id"), "base", "sizes", "flat").mapInArrow(
        choose, "user_id long, rec_items array<long>"
    )


def backfill(lists: DataFrame, top: Column, k: int = TOP_K) -> DataFrame:
    """Distinct items cut to ``k`` and filled up from ``top``; an empty or missing list stays empty."""
    filled = F.slice(F.array_distinct(F.concat("rec_items", top)), 1, k)
    empty = F.array().cast("array<bigint>")
    return lists.select(
        "user_id", F.when(F.size(F.coalesce("rec_items", empty)) > 0, filled).otherwise(empty).alias("rec_items")
    )


def rerank(
    recs: DataFrame,
    lines: DataFrame,
    top: Column,
    k: int = TOP_K,
    gamma: float = GAMMA,
    vectors: DataFrame | None = None,
    lam: float = MMR_LAMBDA,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Candidates to final lists: drop seen, blend, diversify when vectors are given, fill up."""
    pool = recs if seen is None else filter_seen(recs, seen)
    mixed = blend(pool, popularity_z(lines), gamma)
    lists = to_lists(mixed) if vectors is None else mmr(mixed, vectors, lam, k)
    return backfill(lists, top, k)


# -- fallbacks and lookups ---------------------------------------------------------------------------------------


def popular_fallback(users: DataFrame, lists: DataFrame, top: Column) -> DataFrame:
    """Each user's list, or the popular products for a user without one."""
    found = users.select("user_id").distinct().join(lists, "user_id", "left")
    return found.select(
        "user_id",
        F.coalesce("rec_items", top).alias("rec_items"),
        F.when(F.col("rec_items").isNull(), "popular").otherwise("model").alias("source"),
    )


def with_product(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add product fields, with stand-ins for products the catalog lacks."""
    known = catalog.select("product_id", "product_name", "aisle", "department")
    named = df.join(known, "product_id", "left")
    return named.withColumns(
        {
            "product_name": F.coalesce("product_name", F.concat(F.lit("Product_"), F.col("product_id").cast("string"))),
            "aisle": F.coalesce("aisle", F.lit("Unknown")),
            "department": F.coalesce("department", F.lit("Unknown")),
        }
    )


def dual_recommendations(
    personal: DataFrame, segment_recs: DataFrame, catalog: DataFrame, n: int = 5
) -> DataFrame:
    """Personal (user_id, product_id, score) and segment (user_id, product_id, score, rank) lists with product fields."""
    own = ranking.top_n_per(personal, ["user_id"], [F.desc("score"), F.col("product_id")], n).withColumn(
        "source", F.lit("personal")
    )
    shared = segment_recs.filter(F.col("rank") <= n).withColumn("source", F.lit("segment"))
    columns = ["user_id", "source", "rank", "product_id", "score"]
    return with_product(own.select(*columns).unionByName(shared.select(*columns)), catalog)


def preference(scored: DataFrame, n: int = PREFERENCE_SHOWN) -> DataFrame:
    """The ``n`` best (user_id, product_id, product_name, normalized_score) rows per user with their bands."""
    top = ranking.top_n_per(scored, ["user_id"], [F.desc("normalized_score"), F.col("product_id")], n)
    score = F.col("normalized_score")
    return top.withColumns({"confidence": scores.confidence_band(score), "description": scores.band_description(score)})


def named_products(catalog: DataFrame, query: str) -> DataFrame:
    """product_id and product_name of what ``query`` names: ids, or words that occur in name, aisle or department."""
    words = split_ids(query)
    if words and all(w.isdigit() for w in words):
        return catalog.filter(F.col("product_id").isin([int(w) for w in words])).select("product_id", "product_name")
    return search.word_matches(catalog, words).select("product_id", "product_name")


def preferred(
    users: DataFrame, items: DataFrame, names: DataFrame, n: int = PREFERENCE_SHOWN, bounds: tuple[float, float] = scores.MODEL_BOUNDS
) -> DataFrame:
    """The ``n`` best of the named products for each user, with score, normalised score, rank and bands.

    ``users`` and ``items`` are (id, vector), ``names`` (product_id, product_name) of the products to score. Factors
    meet in blocks and each pair of blocks leaves ``n`` rows per user; neither a list of products nor the pairs are
    ever held. Rows are ranked by the normalised score of three places, then by product.
    """
    low, high = bounds

    def normalised(score):
        return np.round((np.clip(score, low, high) - low) / (high - low), 3)

    wanted = items.join(names.select(F.col("product_id").cast("long").alias("id")).distinct(), "id", "left_semi")
    top = vectors.largest_products(wanted, users, n, normalised).found.select(
        F.col("query_id").alias("user_id"), F.col("id").alias("product_id"), F.round("score", 3).alias("score"),
        F.col("key").alias("normalized_score"), "rank",
    )
    band = F.col("normalized_score")
    return top.join(names.withColumn("product_id", F.col("product_id").cast("long")), "product_id").withColumns(
        {"confidence": scores.confidence_band(band), "description": scores.band_description(band)}
    )


def user_product_preference(model: Recommender, users: DataFrame, catalog: DataFrame, query: str) -> DataFrame:
    """Preference of users for the products named in ``query`` (``named_products``): the best few of each user.

    A user or a product that the model does not know scores 0.
    """
    names = named_products(catalog, query)
    zeros = F.array_repeat(F.lit(0.0), model.model.rank)
    user_factors, item_factors = _factors(model)

    def filled(wanted: DataFrame, known: DataFrame, number: str, factors: DataFrame) -> DataFrame:
        named = known.join(factors.withColumnRenamed("id", number), number).select(known.columns[0], "vector")
        vector = F.coalesce(F.col("vector").cast("array<double>"), zeros)
        return wanted.join(named, known.columns[0], "left").select(F.col(known.columns[0]).alias("id"), vector.alias("vector"))

    asked = users.select(F.col("user_id").cast("long").alias("user_id")).distinct()
    products = names.select(F.col("product_id").cast("long").alias("product_id")).distinct()
    return preferred(
        filled(asked, model.users.select("user_id", "u"), "u", user_factors),
        filled(products, model.products.select("product_id", "i"), "i", item_factors),
        names,
    )


# -- run history -------------------------------------------------------------------------------------------------


def run_trend(runs: DataFrame) -> DataFrame:
    """One row per run in time order, from ``sources.files.read_run_metrics`` rows.

    The time is the reported finish (with or without a zone), else the stamp in the run id, else the file time.
    """
    finished = F.regexp_replace("finished_at_utc", "Z$", "")
    stamp = F.regexp_extract("run_id", r"(\d{8}-\d{6})", 1)
    when = F.coalesce(
        F.try_to_timestamp(finished),
        F.try_to_timestamp(stamp, F.lit("yyyyMMdd-HHmmss")),
        F.col("file_time"),
    )
    variant = (
        F.when(F.col("run_id").contains("als-postrank-"), "als-postrank")
        .when(F.col("run_id").contains("als-"), "als")
        .otherwise("unknown")
    )
    names = ("precision", "recall", "map", "ndcg")
    return runs.select(
        "run_id",
        variant.alias("variant"),
        when.alias("finished_at"),
        *[F.coalesce(F.col(f"als.{m}"), F.lit(0.0)).alias(f"als_{m}") for m in names],
        *[F.coalesce(F.col(f"baseline.{m}"), F.lit(0.0)).alias(f"baseline_{m}") for m in names],
        *[F.col(f"lift.{m}").alias(f"lift_{m}") for m in names],
        "coverage_item",
        "coverage_user_eval",
    ).orderBy("finished_at", "run_id")
