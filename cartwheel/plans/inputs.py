"""Inputs of the registered queries that are derived from the star: damaged tables, candidate lists, segments.

Each has the same definition in SQL, for the check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.plans.star import Star


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def dirty_orders(star: Star) -> DataFrame:
    """Orders with missing users, unknown sets, impossible weekdays, hours and gaps, and doubled rows."""
    o = star.orders
    oid = F.col("order_id")
    damaged = o.select(
        "order_id",
        F.when(oid % 70 != 0, F.col("user_id")).alias("user_id"),
        F.when(oid % 110 == 0, "x").otherwise(F.col("eval_set")).alias("eval_set"),
        F.when(oid % 130 == 0, 0).otherwise(F.col("order_number")).alias("order_number"),
        F.when(oid % 50 == 0, 9).otherwise(F.col("order_dow")).alias("order_dow"),
        F.when(oid % 60 == 0, 24).otherwise(F.col("order_hour_of_day")).alias("order_hour_of_day"),
        F.when(oid % 170 == 0, 31).otherwise(F.col("days_since_prior_order")).alias("days_since_prior_order"),
    )
    doubled = damaged.filter(oid % 90 == 0).withColumn("order_number", F.col("order_number") + 1000)
    return damaged.unionByName(doubled)


DIRTY_ORDERS_SQL = """
d_base AS (SELECT order_id, CASE WHEN order_id % 70 <> 0 THEN user_id END AS user_id,
    CASE WHEN order_id % 110 = 0 THEN 'x' ELSE eval_set END AS eval_set,
    CASE WHEN order_id % 130 = 0 THEN 0 ELSE order_number END AS order_number,
    CASE WHEN order_id % 50 = 0 THEN 9 ELSE order_dow END AS order_dow,
    CASE WHEN order_id % 60 = 0 THEN 24 ELSE order_hour_of_day END AS order_hour_of_day,
    CASE WHEN order_id % 170 = 0 THEN 31 ELSE days_since_prior_order END AS days_since_prior_order
  FROM b_orders),
d_orders AS (SELECT * FROM d_base UNION ALL
  SELECT order_id, user_id, eval_set, order_number + 1000, order_dow, order_hour_of_day, days_since_prior_order
  FROM d_base WHERE order_id % 90 = 0),
d_once AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
    ORDER BY user_id NULLS FIRST, eval_set NULLS FIRST, order_number NULLS FIRST, order_dow NULLS FIRST,
      order_hour_of_day NULLS FIRST, days_since_prior_order NULLS FIRST) AS rn
  FROM d_orders WHERE order_id IS NOT NULL) t WHERE rn = 1),
c_orders AS (SELECT * FROM d_once WHERE user_id IS NOT NULL AND eval_set IN ('prior', 'train', 'test')
  AND order_number >= 1 AND order_dow BETWEEN 0 AND 6 AND order_hour_of_day BETWEEN 0 AND 23
  AND (days_since_prior_order IS NULL OR days_since_prior_order BETWEEN 0 AND 30))
"""


def dirty_lines(star: Star) -> DataFrame:
    """Prior lines with missing orders, unknown products, impossible cart positions and reorder flags."""
    oid, pid = F.col("order_id"), F.col("product_id")
    return star.prior.select(
        F.when(oid % 140 != 0, oid).alias("order_id"),
        F.when(pid % 97 == 0, pid + 1_000_000).otherwise(pid).alias("product_id"),
        F.when(oid % 80 == 0, 0).otherwise(F.col("add_to_cart_order")).alias("add_to_cart_order"),
        F.when(oid % 150 == 0, 2).when(oid % 160 == 0, None).otherwise(F.col("reordered")).alias("reordered"),
    )


DIRTY_LINES_SQL = """
d_lines AS (SELECT CASE WHEN order_id % 140 <> 0 THEN order_id END AS order_id,
    CASE WHEN product_id % 97 = 0 THEN product_id + 1000000 ELSE product_id END AS product_id,
    CASE WHEN order_id % 80 = 0 THEN 0 ELSE add_to_cart_order END AS add_to_cart_order,
    CASE WHEN order_id % 150 = 0 THEN 2 WHEN order_id % 160 = 0 THEN NULL ELSE reordered END AS reordered
  FROM b_prior)
"""


def dirty_products(star: Star) -> DataFrame:
    """Products with rare unknown aisles (2.5 %) and blank names, and frequent unknown departments (8.3 %)."""
    pid = F.col("product_id")
    damaged = star.products.select(
        "product_id",
        F.when(pid % 30 == 0, "").otherwise(F.col("product_name")).alias("product_name"),
        F.when(pid % 40 == 0, F.col("aisle_id") + 1000).otherwise(F.col("aisle_id")).alias("aisle_id"),
        F.when(pid % 12 == 0, F.col("department_id") + 1000).otherwise(F.col("department_id")).alias("department_id"),
    )
    doubled = damaged.filter(pid % 45 == 0).withColumn("aisle_id", F.col("aisle_id") + 5000)
    return damaged.unionByName(doubled)


DIRTY_PRODUCTS_SQL = """
d_pbase AS (SELECT product_id, CASE WHEN product_id % 30 = 0 THEN '' ELSE product_name END AS product_name,
    CASE WHEN product_id % 40 = 0 THEN aisle_id + 1000 ELSE aisle_id END AS aisle_id,
    CASE WHEN product_id % 12 = 0 THEN department_id + 1000 ELSE department_id END AS department_id FROM b_products),
d_products AS (SELECT * FROM d_pbase UNION ALL
  SELECT product_id, product_name, aisle_id + 5000, department_id FROM d_pbase WHERE product_id % 45 = 0),
p_once AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id
    ORDER BY product_name NULLS FIRST, aisle_id NULLS FIRST, department_id NULLS FIRST) AS rn FROM d_products) t
  WHERE rn = 1),
p_named AS (SELECT * FROM p_once WHERE product_name <> ''
  OR (SELECT COUNT(*) FILTER (WHERE product_name = '') >= 0.05 * COUNT(*) FROM p_once)),
p_aisled AS (SELECT * FROM p_named WHERE aisle_id IN (SELECT aisle_id FROM b_aisles)
  OR (SELECT COUNT(*) FILTER (WHERE aisle_id NOT IN (SELECT aisle_id FROM b_aisles)) >= 0.05 * COUNT(*) FROM p_named)),
c_products AS (SELECT * FROM p_aisled WHERE department_id IN (SELECT department_id FROM b_departments)
  OR (SELECT COUNT(*) FILTER (WHERE department_id NOT IN (SELECT department_id FROM b_departments))
      >= 0.05 * COUNT(*) FROM p_aisled))
"""


def candidate_rows(star: Star, width: int = 15) -> DataFrame:
    """Candidates of every user: ``width`` products spread over the catalog with falling, some users flat, scores."""
    users = star.orders.select("user_id").distinct()
    n = star.products.agg(F.count(F.lit(1))).scalar()
    long = users.select("user_id", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("pos"))
    score = F.when(F.col("user_id") % 11 == 0, F.lit(1.0)).otherwise(F.lit(1.0) / (1 + F.col("pos")))
    return long.select(
        "user_id", "pos", ((F.col("user_id") * 31 + F.col("pos") * 17) % n).alias("product_id"), score.alias("score")
    )


CANDIDATES_SQL = """
k_recs AS (SELECT user_id, CAST(pos AS INT) AS pos,
    (user_id * 31 + pos * 17) % (SELECT COUNT(*) FROM b_products) AS product_id,
    CASE WHEN user_id % 11 = 0 THEN 1.0 ELSE CAST(1.0 AS DOUBLE) / (1 + pos) END AS score
  FROM (SELECT DISTINCT user_id FROM b_orders) u, range(15) r(pos))
"""

RFM_SQL = """
g_last AS (SELECT user_id, days_since_prior_order AS days FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
    ORDER BY order_number DESC, order_id) AS rn FROM b_orders) t WHERE rn = 1),
g_rfm AS (SELECT user_id, LEAST(COALESCE(CAST(days AS DOUBLE), 0), 60) AS "R", f AS "F", COALESCE(m, 1.0) AS "M"
  FROM g_last
  JOIN (SELECT user_id, COUNT(DISTINCT order_id) AS f FROM b_orders GROUP BY 1) USING (user_id)
  LEFT JOIN (SELECT user_id, AVG(items) AS m FROM (SELECT order_id, COUNT(*) AS items FROM b_train GROUP BY 1) i
    JOIN b_orders USING (order_id) GROUP BY 1) USING (user_id)),
g_seg AS (SELECT *, CAST(user_id % 10 AS INT) AS segment FROM g_rfm),
g_z AS (SELECT *,
    -("R" - (SELECT AVG("R") FROM g_seg)) / (SELECT stddev_samp("R") FROM g_seg) AS r_z,
    ("F" - (SELECT AVG("F") FROM g_seg)) / (SELECT stddev_samp("F") FROM g_seg) AS f_z,
    ("M" - (SELECT AVG("M") FROM g_seg)) / (SELECT stddev_samp("M") FROM g_seg) AS m_z
  FROM g_seg),
g_hv AS (SELECT *, ROUND(0.4 * COALESCE(r_z, 0) + 0.3 * COALESCE(f_z, 0) + 0.3 * COALESCE(m_z, 0), 9) AS hv FROM g_z)
"""

SEGPOP_SQL = """
s_cnt AS (SELECT user_id % 10 AS segment, product_id, COUNT(*) AS cnt FROM b_all JOIN b_orders USING (order_id)
  GROUP BY 1, 2),
s_glob AS (SELECT product_id, COUNT(*) AS gcnt FROM b_all GROUP BY 1),
s_score AS (SELECT segment, product_id, cnt,
    (cnt + 500.0::DOUBLE * (CAST(gcnt AS DOUBLE) / (SELECT COUNT(*) FROM b_all))) / (SUM(cnt) OVER (PARTITION BY segment) + 500.0::DOUBLE) AS score,
    CAST(cnt AS DOUBLE) / SUM(cnt) OVER (PARTITION BY segment) AS support_seg,
    CAST(gcnt AS DOUBLE) / (SELECT COUNT(*) FROM b_all) AS support_global
  FROM s_cnt JOIN s_glob USING (product_id)),
s_pop AS (SELECT CAST(segment AS INT) AS segment, product_id, score, CAST(rank AS INT) AS rank, support_seg, support_global FROM (SELECT *,
    ROW_NUMBER() OVER (PARTITION BY segment ORDER BY score DESC, cnt DESC, product_id) AS rank FROM s_score) t
  WHERE rank <= 30)
"""


def segments(star: Star, users: DataFrame) -> DataFrame:
    """A segment that does not depend on clustering, so that results can be compared exactly."""
    return users.withColumn("segment", (F.col("user_id") % 10).cast("int"))
