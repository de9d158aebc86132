"""Customer segments by recency, frequency and basket size."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.operators import ranking
from cartwheel.session import shared_dir

# Segmentation parameters and the weights of the value score.
SEGMENTS, R_CAP, TOP_N, BETA, SEED = 10, 60, 30, 500.0, 42
VALUE_WEIGHTS = (0.4, 0.3, 0.3)
HIGH_VALUE_USERS, RANDOM_USERS, PRODUCTS_PER_SEGMENT = 150, 150, 5


def rfm(orders: DataFrame, train: DataFrame, r_cap: int = R_CAP) -> DataFrame:
    """R: gap before the last order, capped. F: orders. M: mean items per held-out order, 1 without any."""
    per_user = orders.groupBy("user_id").agg(
        F.max_by("days_since_prior_order", F.struct(F.col("order_number"), -F.col("order_id"))).alias("days"),
        F.countDistinct("order_id").alias("F"),
    )
    sizes = train.groupBy("order_id").agg(F.count(F.lit(1)).alias("items"))
    baskets = (
        sizes.join(orders.select("order_id", "user_id"), "order_id")
        .groupBy("user_id")
        .agg(F.avg("items").alias("M"))
    )
    recency = F.least(F.coalesce(F.col("days").cast("double"), F.lit(0.0)), F.lit(float(r_cap)))
    return (
        per_user.join(baskets, "user_id", "left")
        .select("user_id", recency.alias("R"), "F", "M")
        .na.fill({"F": 1, "M": 1.0})
    )


def _kept(users: DataFrame) -> DataFrame:
    """Fitting passes over the users several times; the checkpoint spares it the joins behind them."""
    shared_dir(users.sparkSession)
    return users.select("user_id", "R", "F", "M").checkpoint()


def _assembled(users: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=["R", "F", "M"], outputCol="raw").transform(users)


def segment_users(users: DataFrame, k: int = SEGMENTS, seed: int = SEED) -> DataFrame:
    """K-means on standardised R, F and M; no rows when there are fewer than two users."""
    users = _kept(users)
    n = users.limit(max(k, 2)).count()
    if n < 2:
        empty = "user_id long, R double, F long, M double, segment int"
        return users.sparkSession.createDataFrame([], empty)
    vectors = _assembled(users)
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="raw", outputCol="features").fit(vectors)
    scaled = scaler.transform(vectors)
    model = KMeans(k=min(k, n), seed=seed, predictionCol="segment").fit(scaled)
    return model.transform(scaled).select("user_id", "R", "F", "M", "segment")


def with_z_scores(users: DataFrame) -> DataFrame:
    """Add r_z, f_z and m_z over all users; recency is negated so that larger is better."""
    stats = users.agg(
        *[F.avg(c).alias(f"mu_{c}") for c in "RFM"], *[F.stddev_samp(c).alias(f"sd_{c}") for c in "RFM"]
    ).select(F.struct("*")).scalar()

    def z(c: str) -> Column:
        return F.when(stats[f"sd_{c}"] > 0, (F.col(c) - stats[f"mu_{c}"]) / stats[f"sd_{c}"]).otherwise(F.lit(0.0))

    return users.withColumns({"r_z": -z("R"), "f_z": z("F"), "m_z": z("M")})


def segment_popularity(
    segments: DataFrame, orders: DataFrame, lines: DataFrame, top_n: int = TOP_N, beta: float = BETA
) -> DataFrame:
    """Smoothed popularity of products per segment, the first ``top_n`` of each, with both supports.

    The segment is attached to the orders, so the lines are shuffled once, on the order.
    """
    placed = orders.select("order_id", "user_id").join(segments.select("user_id", "segment"), "user_id", "left")
    counted = (
        lines.select("order_id", "product_id")
        .join(placed.select("order_id", "segment"), "order_id", "left")
        .groupBy("segment", "product_id")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    # One row per segment.
    sizes = counted.groupBy("segment").agg(F.sum("cnt").alias("seg_total"))
    sizes = sizes.withColumn("total", F.sum("seg_total").over(Window.partitionBy()))
    # A product has one row per segment here.
    overall = counted.withColumn("gcnt", F.sum("cnt").over(Window.partitionBy("product_id")))
    joined = overall.join(sizes, "segment")
    rate = F.col("gcnt") / F.col("total")
    scored = joined.select(
        "segment",
        "product_id",
        "cnt",
        ((F.col("cnt") + beta * rate) / (F.col("seg_total") + beta)).alias("score"),
        (F.col("cnt") / F.col("seg_total")).alias("support_seg"),
        rate.alias("support_global"),
    )
    best = [F.desc("score"), F.desc("cnt"), F.asc("product_id")]
    return ranking.top_n_per(scored, ["segment"], best, top_n).select(
        "segment", "product_id", "score", "rank", "support_seg", "support_global"
    )


def cluster_summary(users: DataFrame) -> DataFrame:
    stats = [
        F.round(fn(c), 4).alias(f"{c}_{name}")
        for c in "RFM"
        for name, fn in (("mean", F.avg), ("min", F.min), ("max", F.max))
    ]
    return users.groupBy("segment").agg(F.count("user_id").alias("user_id_count"), *stats)


def segment_centroids(users: DataFrame) -> DataFrame:
    """Mean R, F, M and z-scores per segment; ``users`` carries the z-scores."""
    means = [F.round(F.avg(c), 3).alias(c.lower()) for c in ("R", "F", "M", "r_z", "f_z", "m_z")]
    return users.groupBy("segment").agg(*means)


def _lift() -> Column:
    return F.col("support_seg") / F.greatest(F.col("support_global"), F.lit(1e-9))


def lift_matrix(popularity: DataFrame, top: int = 30) -> tuple[DataFrame, list[str]]:
    """Segment x product lifts of the ``top`` products that vary most between segments; missing lifts are 1."""
    shared_dir(popularity.sparkSession)
    # A short table (products kept per segment) that is read twice.
    lifts = popularity.select("segment", "product_id", _lift().alias("lift")).checkpoint()
    varied = lifts.groupBy("product_id").agg(
        F.coalesce(F.var_samp("lift"), F.lit(0.0)).alias("var"), F.avg("lift").alias("mean")
    )
    order = [F.desc(F.round("var", 9)), F.desc(F.round("mean", 9)), F.asc("product_id")]
    # The chosen ids become column names: at most ``top`` values reach the driver.
    ids = [r["product_id"] for r in varied.orderBy(*order).limit(top).select("product_id").collect()]
    wide = (
        lifts.filter(F.col("product_id").isin(ids)).groupBy("segment").pivot("product_id", ids).agg(F.max("lift"))
    )
    return wide.na.fill(1.0), [str(i) for i in ids]


def segment_lift(popularity: DataFrame, top: int = 30) -> DataFrame:
    """The lift matrix as rows (segment, product_id, lift)."""
    wide, ids = lift_matrix(popularity, top)
    return wide.unpivot("segment", ids, "product_id", "lift").withColumn("product_id", F.col("product_id").cast("long"))


def rfm_pca(users: DataFrame, k: int = 2) -> DataFrame:
    """Projection of R, F and M on their first ``k`` principal components, over all users."""
    vectors = _assembled(_kept(users))
    centered = StandardScaler(withMean=True, withStd=False, inputCol="raw", outputCol="centered").fit(vectors)
    data = centered.transform(vectors)
    model = PCA(k=k, inputCol="centered", outputCol="pc").fit(data)
    axes = vector_to_array("pc")
    return model.transform(data).select("user_id", *[axes[i].alias(f"pc{i + 1}") for i in range(k)])


def with_value_score(users: DataFrame) -> DataFrame:
    """Add ``hv``, the weighted sum of the z-scores; a missing z-score counts as 0."""
    weighted = zip(VALUE_WEIGHTS, ("r_z", "f_z", "m_z"), strict=True)
    return users.withColumn("hv", F.round(sum(w * F.coalesce(c, F.lit(0.0)) for w, c in weighted), 9))


def high_value_users(users: DataFrame, n: int = HIGH_VALUE_USERS) -> DataFrame:
    """The ``n`` users with the highest value score."""
    return with_value_score(users).orderBy(F.desc("hv"), "user_id").limit(n)


def user_segment(users: DataFrame, user_id: int) -> DataFrame:
    return users.filter(F.col("user_id") == user_id).select("user_id", "segment")


def user_profile(users: DataFrame, user_id: int) -> DataFrame:
    return users.filter(F.col("user_id") == user_id)


def segment_recommendations(users: DataFrame, popularity: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` products of each user's segment.

    The product side has at most ``n`` rows per segment: the planner broadcasts it below its size limit, and splits
    the users of a large segment over several tasks beyond.
    """
    top = popularity.filter(F.col("rank") <= n).select("segment", "product_id", "score", "rank")
    return users.select("user_id", "segment").join(top, "segment").select(
        "user_id", "segment", "product_id", "score", "rank"
    )


def cluster_recommendations(popularity: DataFrame, segment: int, n: int = 10) -> DataFrame:
    """The ``n`` best products of one segment."""
    return popularity.filter(F.col("segment") == segment).orderBy("rank").limit(n)


def same_segment_users(users: DataFrame, user_ids: list[int], n: int = 5) -> DataFrame:
    """For each given user the first ``n`` other users of the segment, with the segment's statistics.

    The first n + 1 users per segment are enough for any of its members, so the candidate side stays small.
    """
    asked = users.filter(F.col("user_id").isin(list(user_ids))).select("user_id", "segment")
    first = ranking.top_n_per(users.select("segment", F.col("user_id").alias("similar_user_id")), ["segment"],
                              [F.col("similar_user_id")], n + 1, name="_place")
    others = asked.join(first, "segment").filter(F.col("user_id") != F.col("similar_user_id"))
    listed = ranking.top_n_per(others, ["user_id"], [F.col("similar_user_id")], n).drop("_place")
    return listed.join(cluster_summary(users), "segment")


def cohort_union(high_value: DataFrame, random: DataFrame, popularity: DataFrame, rows: int | None = None) -> DataFrame:
    """Segment products of both cohorts; the first ``rows`` in cohort, user and rank order if that is given."""
    topn = ranking.first_k(popularity, PRODUCTS_PER_SEGMENT)

    def side(users: DataFrame, label: str) -> DataFrame:
        joined = users.select("user_id", "segment", "hv").join(
            topn.select("segment", "product_id", "rank", "score"), "segment", "left"
        )
        return joined.withColumn("cohort", F.lit(label))

    both = side(high_value, "high_value").unionByName(side(random, "random"))
    return both if rows is None else both.orderBy("cohort", F.desc("hv"), "user_id", "rank").limit(rows)


def cohort_export(cohorts: DataFrame, users: DataFrame, popularity: DataFrame) -> DataFrame:
    """One nested record per user of the cohorts: segment, z-scores and the segment's products."""
    chosen = cohorts.select("user_id").distinct()
    product = F.struct("rank", "product_id", "score")
    topn = ranking.first_k(popularity, PRODUCTS_PER_SEGMENT).groupBy("segment").agg(
        F.sort_array(F.collect_list(product)).alias("top_products")
    )
    return (
        users.join(chosen, "user_id", "left_semi")
        .join(topn, "segment", "left")
        .select(
            "user_id",
            "segment",
            F.struct("r_z", "f_z", "m_z").alias("rfm_z"),
            F.coalesce("top_products", F.array().cast("array<struct<rank:int,product_id:bigint,score:double>>")).alias("top_products"),
        )
    )
