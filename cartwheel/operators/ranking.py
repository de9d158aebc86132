"""Last rows, top lists and distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.plans.skew import number_in_group


def last_order(orders: DataFrame) -> DataFrame:
    """Per user the row with the largest order number (order id where there is no number); an aggregate, no window."""
    if "order_number" in orders.columns:
        by = F.struct(F.col("order_number"), -F.col("order_id"))
    elif "order_id" in orders.columns:
        by = F.col("order_id")
    else:
        raise ValueError("orders need order_number or order_id")
    rest = [c for c in orders.columns if c != "user_id"]
    picked = orders.groupBy("user_id").agg(F.max_by(F.struct(*rest), by).alias("_row"))
    return picked.select(*[F.col(c) if c == "user_id" else F.col("_row")[c].alias(c) for c in orders.columns])


def top_n_per(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str = "rank") -> DataFrame:
    """First ``n`` rows per key; Spark cuts each map partition to ``n`` per key before the shuffle."""
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(name) <= n)


def dense_top_n(segment_popularity: DataFrame, n: int = 10, key: str = "segment", score: str = "score") -> DataFrame:
    """Rows of the ``n`` highest distinct scores per cluster, ties included."""
    by = Window.partitionBy(key).orderBy(F.desc(score))
    return (
        segment_popularity.drop("rank").withColumn("rank", F.dense_rank().over(by))
        .filter(F.col("rank") <= n)
        .select(key, "product_id", score, "rank")
    )


def rank_if_missing(df: DataFrame, key: str = "segment") -> DataFrame:
    """Running number by score, the highest first, then product, within the segment where there is no rank yet.

    A missing score comes last. Rows are numbered in range partitions of segment and score, which cut a large segment.
    """
    if "rank" in df.columns or "score" not in df.columns:
        return df
    ordered = df.withColumns({"_none": F.col("score").isNull(), "_down": -F.col("score")})
    numbered = number_in_group(ordered, [key], ["_none", "_down", "product_id"])
    return numbered.select(*df.columns, F.col("rn").cast("int").alias("rank"))


def first_k(df: DataFrame, k: int, key: str = "segment") -> DataFrame:
    """First ``k`` products per segment by rank."""
    ranked = rank_if_missing(df, key)
    place = Window.partitionBy(key).orderBy("rank", "product_id")
    return ranked.withColumn("_place", F.row_number().over(place)).filter(F.col("_place") <= k).drop("_place")


def ecdf(df: DataFrame, column: str, x_max: int = 60) -> DataFrame:
    """Empirical distribution of all values, shown up to ``x_max``: per value its count and the share at or below it.

    Values are counted first. The running sum is taken within whole-number blocks (at most ``x_max`` + 2 for positive
    values) and shifted by the sizes of the blocks before.
    """
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_block", F.least(F.floor("value"), F.lit(x_max + 1)))
    )
    blocks = counts.groupBy("_block").agg(F.sum("n").alias("_rows"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "_block",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy()).alias("_total"),
    )
    running = Window.partitionBy("_block").orderBy("value")
    return (
        counts.where(F.col("value") <= x_max)
        .withColumn("_sum", F.sum("n").over(running))
        .join(offsets, "_block")
        .select("value", "n", ((F.col("_before") + F.col("_sum")) / F.col("_total")).alias("cdf"))
    )


def random_users(df: DataFrame, n: int, seed: int = 42, key: str = "user_id") -> DataFrame:
    """A seeded sample of ``n`` rows (all, if there are fewer), the same under any partitioning."""
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.orderBy(draw, key).limit(n)
