"""Offline evaluation of recommendation lists.

Lists are (user_id, rec_items array) frames, bounded by the list length. The truth stays one row per user and product:
a user with very many purchases is never gathered into one array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scores import lift
from cartwheel.operators import joins

METRICS = ("precision", "recall", "map", "ndcg")


def ground_truth(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct (user_id, product_id) of the held-out lines."""
    return (
        lines.select("order_id", "product_id")
        .join(orders.select("order_id", "user_id"), "order_id")
        .select("user_id", "product_id")
        .distinct()
    )


def _inverse_log(rank: Column) -> Column:
    return F.lit(1.0) / F.log2(rank + F.lit(1.0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def ideal_dcg(n: Column) -> Column:
    """Discounted gain of a list that begins with ``n`` hits."""
    ranks = F.filter(F.sequence(F.lit(0), n.cast("int")), lambda r: r > 0)
    return _total(F.transform(ranks, _inverse_log))


def ranking_metrics(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """Per user with both a list and a truth: hits, precision (over k), recall, average precision over hits, NDCG.

    List places and truth rows meet once by user and product; a user's row then holds the ranks of the hits in rising
    order, ``k`` at most, and all metrics are sums over that array: the i-th hit at rank r has precision i / r and gain
    1 / log2(r + 1).
    """
    places = recs.select("user_id", F.posexplode_outer(F.slice("rec_items", 1, k)).alias("_pos", "product_id"), F.lit(1).alias("_listed"))
    wanted = truth.select("user_id", "product_id", F.lit(1).alias("_wanted"))
    rank = F.when(F.col("_wanted").isNotNull(), F.col("_pos") + 1)
    met = (
        places.join(wanted, ["user_id", "product_id"], "full")
        .groupBy("user_id")
        .agg(
            F.count_distinct(F.when(F.col("_wanted").isNotNull(), F.col("product_id"))).alias("gt_size"),
            F.max("_listed").alias("_listed"),
            F.array_sort(F.collect_list(rank)).alias("ranks"),
        )
        .where("gt_size > 0 and _listed is not null")
    )
    hits = F.size("ranks").cast("double")
    at_hits = _total(F.transform("ranks", lambda r, i: (i + 1) / r))
    return met.select(
        "user_id",
        "gt_size",
        hits.alias("hits"),
        (hits / k).alias("precision"),
        (hits / F.col("gt_size")).alias("recall"),
        F.coalesce(F.try_divide(at_hits, hits), F.lit(0.0)).alias("ap_hits"),
        (_total(F.transform("ranks", _inverse_log)) / ideal_dcg(F.least(F.col("gt_size"), F.lit(k)))).alias("ndcg"),
    )


def ranking_summary(per_user: DataFrame) -> DataFrame:
    return per_user.agg(
        F.count(F.lit(1)).alias("users_evaluated"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("ap_hits").alias("map"),
        F.avg("ndcg").alias("ndcg"),
    )


def top_items(lines: DataFrame, k: int) -> Column:
    """The global top-k products as one array (length k at most), -1 standing in for an empty list."""
    top = joins.top_products(lines, k)
    rows = top.agg(F.collect_list(F.struct((-F.col("n_lines")).alias("n"), "product_id")).alias("top"))
    ids = F.transform(F.sort_array("top"), lambda x: x["product_id"])
    fallback = F.array(F.lit(-1).cast("long"))
    return rows.select(F.when(F.size("top") > 0, ids.cast("array<bigint>")).otherwise(fallback)).scalar()


def popularity_baseline(lines: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """The same global list for every user with a truth."""
    return truth.select("user_id").distinct().withColumn("rec_items", top_items(lines, k))


def metrics_lift(model: DataFrame, baseline: DataFrame) -> DataFrame:
    """One row: both summaries side by side with the lift of each metric."""
    base = baseline.select(F.struct("*").alias("r")).scalar()
    return model.select(
        "users_evaluated",
        *[F.col(m).alias(f"model_{m}") for m in METRICS],
        *[base[m].alias(f"baseline_{m}") for m in METRICS],
        *[lift(F.col(m), base[m]).alias(f"lift_{m}") for m in METRICS],
    )


def coverage(recs: DataFrame, truth: DataFrame, catalog: DataFrame) -> DataFrame:
    """User and item coverage of the lists; the user share may exceed 1. ``catalog`` has the product ids to cover."""

    def count_distinct(df: DataFrame, key: str) -> Column:
        return df.agg(F.countDistinct(key)).scalar()

    evaluated = recs.select("user_id").join(truth.select("user_id").distinct(), "user_id", "left_semi")
    items = recs.select(F.explode("rec_items").alias("product_id"))
    counts = recs.agg(F.countDistinct("user_id").alias("users_with_recs")).select(
        count_distinct(truth, "user_id").alias("users_with_gt"),
        "users_with_recs",
        count_distinct(evaluated, "user_id").alias("users_evaluated"),
        count_distinct(catalog, "product_id").alias("catalog_size"),
        count_distinct(items, "product_id").alias("items_recommended"),
    )

    def share(a: str, b: str, name: str) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0)).alias(name)

    return counts.select(
        "*",
        share("users_with_recs", "users_with_gt", "coverage_user_rec"),
        share("users_evaluated", "users_with_gt", "coverage_user_eval"),
        share("items_recommended", "catalog_size", "coverage_item"),
    )
