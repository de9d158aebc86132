"""Joins, unions and distinct keys.

No join carries a size-blind broadcast hint: the planner broadcasts a side below ``autoBroadcastJoinThreshold`` and
adaptive execution splits skewed partitions of the rest. Only frames bounded by a row limit are hinted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.operators import quality

# Products of one order that a task pairs with each other.
BASKET_BLOCK = 1000


def all_lines(prior: DataFrame, train: DataFrame) -> DataFrame:
    return prior.unionByName(train)


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def combine(orders: DataFrame, lines: DataFrame) -> DataFrame:
    return orders.join(lines, "order_id")


def denormalize(
    orders: DataFrame, lines: DataFrame, products: DataFrame, aisles: DataFrame, departments: DataFrame
) -> DataFrame:
    """Lines with their order, product, aisle and department; rows without a match go."""
    return (
        combine(orders, lines)
        .join(products, "product_id")
        .join(aisles, "aisle_id")
        .join(departments, "department_id")
    )


def denormalize_left(
    lines: DataFrame, orders: DataFrame, products: DataFrame, aisles: DataFrame, departments: DataFrame
) -> DataFrame:
    """Every line with whatever order, product, department and aisle it finds."""
    return (
        lines.join(orders, "order_id", "left")
        .join(products, "product_id", "left")
        .join(departments, "department_id", "left")
        .join(aisles, "aisle_id", "left")
    )


def product_catalog(products: DataFrame, aisles: DataFrame, departments: DataFrame) -> DataFrame:
    return products.join(aisles, "aisle_id", "left").join(departments, "department_id", "left").select(
        "product_id", "product_name", "aisle_id", "aisle", "department_id", "department"
    )


def fk_filter_small(child: DataFrame, parent: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Drop children with an unknown key when they are rare, else keep them; returns the report as well."""
    flagged, rule, flag = quality.foreign_key_rule(child, parent, key)
    kept, report = quality.prune_once(flagged, [rule])
    return kept.drop(flag).select(*child.columns), report


def fk_filter_large(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Children whose key is in the parent; NULL keys go."""
    return child.join(parent.select(key).distinct(), key, "left_semi").select(*child.columns)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the child that the parent lacks."""
    return distinct_keys(child, key).join(parent.select(key), key, "left_anti")


def order_users(orders: DataFrame) -> DataFrame:
    """One user per order (the smallest, should an order occur twice)."""
    return orders.groupBy("order_id").agg(F.min("user_id").alias("user_id"))


def lines_with_user(lines: DataFrame, orders: DataFrame) -> DataFrame:
    return lines.join(order_users(orders), "order_id").select("user_id", *lines.columns)


def top_products(lines: DataFrame, n: int) -> DataFrame:
    """The ``n`` products with most lines, count descending then id."""
    counts = lines.groupBy("product_id").agg(F.count(F.lit(1)).alias("n_lines"))
    return counts.orderBy(F.desc("n_lines"), "product_id").limit(n)


def restrict_top(lines: DataFrame, n: int) -> DataFrame:
    """Lines of the top ``n`` products; the broadcast side has at most ``n`` rows."""
    top = top_products(lines, n).select("product_id")
    return lines.join(F.broadcast(top), "product_id", "left_semi").select(*lines.columns)


def basket_pairs(lines: DataFrame, block: int = BASKET_BLOCK) -> DataFrame:
    """How often two products share an order, each pair once with the smaller id first.

    Repeated products of an order are folded first. The products of an order are dealt into blocks of about ``block``
    by hash, and each pair of blocks is a join key of its own, so that the pairs of a very large order spread over
    many tasks; an order of one block, the usual case, has one key.
    """
    folded = lines.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("times"))
    sizes = folded.groupBy("order_id").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = (
        folded.join(sizes, "order_id")
        .withColumn("own", F.pmod(F.xxhash64("product_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    first = dealt.select("order_id", "own", "other", F.col("product_id").alias("product1_id"), F.col("times").alias("times1"))
    second = dealt.select(
        "order_id", F.col("other").alias("own"), F.col("own").alias("other"), F.col("product_id").alias("product2_id"), F.col("times").alias("times2")
    )
    return (
        first.join(second, ["order_id", "own", "other"])
        .where("product1_id < product2_id")
        .groupBy("product1_id", "product2_id")
        .agg(F.sum(F.col("times1") * F.col("times2")).alias("pair_count"))
    )
