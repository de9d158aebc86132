"""Basket star schema derived from the order, line item and part tables.

``Star`` holds the five tables every operator works on. ``load_star`` derives them once per application and input
folder and writes them to the shared folder, so that queries start from plain Parquet scans.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.plans.skew import number_by_size
from cartwheel.session import scratch, small_tasks, stored


@dataclass(frozen=True)
class Star:
    orders: DataFrame
    lines: DataFrame
    products: DataFrame
    aisles: DataFrame
    departments: DataFrame

    @property
    def prior(self) -> DataFrame:
        return self.lines.filter("eval_set = 'prior'").drop("eval_set")

    @property
    def train(self) -> DataFrame:
        return self.lines.filter("eval_set = 'train'").drop("eval_set")


def derive_orders(orders: DataFrame) -> DataFrame:
    """One row per order, numbered per user by date; the last order of a user is train or test, the rest prior."""
    raw = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("order_date"),
    )
    seq = number_by_size(raw, ["user_id"], ["order_date", "order_id"], lag="order_date")
    gap = F.floor(F.datediff("order_date", "prev") / 10)
    return seq.select(
        "order_id",
        "user_id",
        F.when(F.col("rn") < F.col("group_rows"), "prior")
        .when(F.col("user_id") % 2 == 0, "train")
        .otherwise("test")
        .alias("eval_set"),
        F.col("rn").cast("int").alias("order_number"),
        (F.dayofweek("order_date") - 1).cast("int").alias("order_dow"),
        (F.col("order_id") % 24).cast("int").alias("order_hour_of_day"),
        F.when(F.col("prev").isNotNull(), F.least(gap, F.lit(30))).cast("int").alias("days_since_prior_order"),
    )


def derive_lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order and product with its cart position and whether the user bought the product before."""
    raw = lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_linenumber").alias("ln")
    )

    def picked(rows: DataFrame) -> DataFrame:
        return rows.groupBy("order_id", "product_id").agg(F.min("ln").alias("ln"))

    carts = number_by_size(raw, ["order_id"], ["ln", "product_id"], fold=picked)
    joined = carts.select("order_id", "product_id", F.col("rn").cast("int").alias("add_to_cart_order")).join(
        orders.select("order_id", "user_id", "order_number", "eval_set"), "order_id"
    )
    # Written, as both the first purchases and the lines that are compared with them read it.
    joined = stored(joined.where("user_id is not null and product_id is not null"), "joined-lines")
    # Only products that a user bought in several orders have lines behind the first; by their measured size the
    # planner sends these to the lines, or shuffles both.
    again = joined.groupBy("user_id", "product_id").agg(F.min("order_number").alias("first_number"), F.max("order_number").alias("last"))
    again = stored(again.where("first_number < last").drop("last"), "bought-again")
    later = F.coalesce(F.col("order_number") > F.col("first_number"), F.lit(False))
    return joined.join(again, ["user_id", "product_id"], "left").select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        F.when(F.col("order_number").isNotNull(), later).cast("int").alias("reordered"),
        "eval_set",
    )


def _numbered_names(part: DataFrame, column: str, key: str, name: str) -> DataFrame:
    # The distinct brands and types are dimension values, so this one-task window is a few dozen rows.
    names = part.select(F.col(column).alias(name)).distinct()
    return names.select(F.row_number().over(Window.orderBy(name)).cast("int").alias(key), name)


def derive_dimensions(part: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Products, aisles and departments."""
    aisles = _numbered_names(part, "p_brand", "aisle_id", "aisle")
    departments = _numbered_names(part, "p_type", "department_id", "department")
    products = (
        part.join(aisles, part.p_brand == aisles.aisle)
        .join(departments, part.p_type == departments.department)
        .select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            "aisle_id",
            "department_id",
        )
    )
    return products, aisles, departments


_LOADED: dict[tuple[str, str], Star] = {}


def load_star(spark: SparkSession, sf_dir: str) -> Star:
    """The star as Parquet tables in the shared folder, written on first use by this application."""
    small_tasks(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LOADED:
        _LOADED[key] = write_star(spark, key[1], scratch(spark, "star"))
    return _LOADED[key]


def write_star(spark: SparkSession, sf_dir: str, root: str) -> Star:
    def kept(name: str, df: DataFrame, *partitions: str) -> DataFrame:
        df.write.partitionBy(*partitions).parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    orders = kept("orders", derive_orders(spark.read.parquet(f"{sf_dir}/orders.parquet")))
    lines = derive_lines(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), orders)
    lines = kept("lines", lines, "eval_set")
    dimensions = zip(("products", "aisles", "departments"), derive_dimensions(spark.read.parquet(f"{sf_dir}/part.parquet")))
    return Star(orders, lines, *(kept(name, df) for name, df in dimensions))


# The same mapping for the SQL check.
STAR_SQL = """
b_orders AS (
  SELECT order_id, user_id,
    CASE WHEN rn < n THEN 'prior' WHEN user_id % 2 = 0 THEN 'train' ELSE 'test' END AS eval_set,
    CAST(rn AS INT) AS order_number,
    CAST(dayofweek(order_date) AS INT) AS order_dow,
    CAST(order_id % 24 AS INT) AS order_hour_of_day,
    CASE WHEN prev IS NOT NULL
      THEN CAST(LEAST(FLOOR(date_diff('day', prev, order_date) / 10), 30) AS INT) END AS days_since_prior_order
  FROM (
    SELECT order_id, user_id, order_date,
      ROW_NUMBER() OVER w AS rn, COUNT(*) OVER (PARTITION BY user_id) AS n, LAG(order_date) OVER w AS prev
    FROM (SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date FROM orders) o
    WINDOW w AS (PARTITION BY user_id ORDER BY order_date, order_id)) t),
b_lines AS (
  SELECT order_id, product_id,
    CAST(ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY ln, product_id) AS INT) AS add_to_cart_order,
    CASE WHEN order_number > MIN(order_number) OVER (PARTITION BY user_id, product_id) THEN 1 ELSE 0 END AS reordered,
    eval_set
  FROM (SELECT l_orderkey AS order_id, l_partkey AS product_id, MIN(l_linenumber) AS ln
    FROM lineitem GROUP BY 1, 2) l JOIN b_orders USING (order_id)),
b_prior AS (SELECT order_id, product_id, add_to_cart_order, reordered FROM b_lines WHERE eval_set = 'prior'),
b_train AS (SELECT order_id, product_id, add_to_cart_order, reordered FROM b_lines WHERE eval_set = 'train'),
b_all AS (SELECT * FROM b_prior UNION ALL SELECT * FROM b_train),
b_departments AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY p_type) AS INT) AS department_id, p_type AS department
  FROM (SELECT DISTINCT p_type FROM part) x),
b_aisles AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY p_brand) AS INT) AS aisle_id, p_brand AS aisle
  FROM (SELECT DISTINCT p_brand FROM part) x),
b_products AS (SELECT p_partkey AS product_id, p_name AS product_name, aisle_id, department_id
  FROM part JOIN b_aisles ON aisle = p_brand JOIN b_departments ON department = p_type)
"""
