"""Queries: data quality, joins, set operations, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import features, joins, quality, ranking
from cartwheel.plans.inputs import (
    DIRTY_LINES_SQL,
    DIRTY_ORDERS_SQL,
    DIRTY_PRODUCTS_SQL,
    dirty_lines,
    dirty_orders,
    dirty_products,
    rounded,
)
from cartwheel.plans.registry import query
from cartwheel.plans.star import load_star


@query("star_orders", "SELECT * FROM b_orders")
def star_orders(spark, sf_dir):
    return load_star(spark, sf_dir).orders


@query("star_lines", "SELECT * FROM b_lines")
def star_lines(spark, sf_dir):
    return load_star(spark, sf_dir).lines


@query("drop_duplicates", f", {DIRTY_ORDERS_SQL} SELECT * FROM d_once")
def drop_duplicates(spark, sf_dir):
    return quality.drop_duplicates(dirty_orders(load_star(spark, sf_dir)), ["order_id"])


@query(
    "prune_if_rare",
    f""", {DIRTY_PRODUCTS_SQL}
    SELECT 'product_id not an integer' AS rule, (SELECT COUNT(*) FROM p_once) AS total_rows, 0::BIGINT AS bad_rows,
      (SELECT COUNT(*) FROM p_once) > 0 AS dropped
    UNION ALL SELECT 'product_name blank' AS rule, (SELECT COUNT(*) FROM p_once) AS total_rows,
      (SELECT COUNT(*) FROM p_once WHERE product_name = '') AS bad_rows,
      (SELECT COUNT(*) FROM p_once) > (SELECT COUNT(*) FROM p_named) AS dropped
    UNION ALL SELECT 'aisle_id not in parent', (SELECT COUNT(*) FROM p_named),
      (SELECT COUNT(*) FROM p_named WHERE aisle_id NOT IN (SELECT aisle_id FROM b_aisles)),
      (SELECT COUNT(*) FROM p_named) > (SELECT COUNT(*) FROM p_aisled)
    UNION ALL SELECT 'department_id not in parent', (SELECT COUNT(*) FROM p_aisled),
      (SELECT COUNT(*) FROM p_aisled WHERE department_id NOT IN (SELECT department_id FROM b_departments)),
      (SELECT COUNT(*) FROM p_aisled) > (SELECT COUNT(*) FROM c_products)""",
)
def prune_if_rare(spark, sf_dir):
    star = load_star(spark, sf_dir)
    report = quality.clean_products_report(dirty_products(star), star.aisles, star.departments)[1]
    return report.select("rule", F.col("total").alias("total_rows"), F.col("bad").alias("bad_rows"), "dropped")


@query("prune_if_rare_rows", f", {DIRTY_PRODUCTS_SQL} SELECT * FROM c_products")
def prune_if_rare_rows(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return quality.clean_products_report(dirty_products(star), star.aisles, star.departments)[0]


@query(
    "numeric_or_text",
    "SELECT order_id, CAST(user_id AS BIGINT) AS whole, CAST(days_since_prior_order AS BIGINT) AS gap, eval_set AS word FROM b_orders",
)
def numeric_or_text(spark, sf_dir):
    orders = load_star(spark, sf_dir).orders
    loose = orders.select("order_id", F.col("user_id").cast("string").alias("whole"), F.col("days_since_prior_order").cast("string").alias("gap"), F.col("eval_set").alias("word"))
    return quality.numeric_or_text(loose, ["whole", "gap", "word"])


MIXED_SQL = """
m AS (SELECT order_id, CASE WHEN order_id % 7 = 0 THEN 'n/a' WHEN order_id % 11 = 0 THEN '' WHEN order_id % 13 = 0 THEN NULL
  ELSE CAST(days_since_prior_order AS VARCHAR) END AS raw_days FROM b_orders)
"""


def mixed_days(star):
    oid = F.col("order_id")
    text = (
        F.when(oid % 7 == 0, "n/a")
        .when(oid % 11 == 0, "")
        .when(oid % 13 == 0, None)
        .otherwise(F.col("days_since_prior_order").cast("string"))
    )
    return star.orders.select("order_id", text.alias("raw_days"))


@query(
    "check_int",
    f", {MIXED_SQL} SELECT order_id, raw_days FROM m WHERE TRY_CAST(raw_days AS INT) IS NULL",
)
def check_int(spark, sf_dir):
    return mixed_days(load_star(spark, sf_dir)).filter(quality.not_int("raw_days"))


@query(
    "check_not_blank",
    f", {MIXED_SQL} SELECT order_id FROM m WHERE raw_days IS NULL OR raw_days = ''",
)
def check_not_blank(spark, sf_dir):
    return mixed_days(load_star(spark, sf_dir)).filter(quality.is_blank("raw_days")).select("order_id")


@query(
    "check_domain",
    f", {DIRTY_ORDERS_SQL} SELECT order_id, eval_set FROM d_orders WHERE eval_set IS NULL OR eval_set NOT IN ('prior', 'train', 'test')",
)
def check_domain(spark, sf_dir):
    bad = quality.outside_domain("eval_set", quality.EVAL_SETS)
    return dirty_orders(load_star(spark, sf_dir)).filter(bad).select("order_id", "eval_set")


@query(
    "check_range",
    f""", {DIRTY_ORDERS_SQL} SELECT order_id, order_number, order_dow, order_hour_of_day, days_since_prior_order
    FROM d_orders WHERE NOT (order_number >= 1) OR order_dow NOT BETWEEN 0 AND 6 OR order_hour_of_day NOT BETWEEN 0 AND 23
      OR days_since_prior_order NOT BETWEEN 0 AND 30""",
)
def check_range(spark, sf_dir):
    bad = (
        quality.outside_range("order_number", 1)
        | quality.outside_range("order_dow", 0, 6)
        | quality.outside_range("order_hour_of_day", 0, 23)
        | quality.outside_range("days_since_prior_order", 0, 30, nullable=True)
    )
    return dirty_orders(load_star(spark, sf_dir)).filter(bad).select(
        "order_id", "order_number", "order_dow", "order_hour_of_day", "days_since_prior_order"
    )


@query(
    "duplicate_report",
    f""", {DIRTY_ORDERS_SQL} SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS duplicate_rows, COUNT(*) AS duplicate_keys
    FROM (SELECT COUNT(*) AS n FROM d_orders GROUP BY order_id HAVING COUNT(*) > 1) t""",
)
def duplicate_report(spark, sf_dir):
    return quality.duplicate_report(dirty_orders(load_star(spark, sf_dir)), "order_id")


@query(
    "quality_report",
    f""", {DIRTY_ORDERS_SQL}, f AS (SELECT COALESCE(user_id IS NULL, TRUE) AS b1,
      eval_set IS NULL OR eval_set NOT IN ('prior', 'train', 'test') AS b2, order_number IS NULL OR order_number < 1 AS b3,
      order_dow IS NULL OR order_dow NOT BETWEEN 0 AND 6 AS b4,
      order_hour_of_day IS NULL OR order_hour_of_day NOT BETWEEN 0 AND 23 AS b5,
      days_since_prior_order IS NOT NULL AND days_since_prior_order NOT BETWEEN 0 AND 30 AS b6 FROM d_orders)
    SELECT 1 AS step, 'user_id not an integer' AS rule, COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE b1) AS failing,
      COUNT(*) FILTER (WHERE b1) AS removed FROM f
    UNION ALL SELECT 2, 'eval_set unknown', COUNT(*), COUNT(*) FILTER (WHERE b2), COUNT(*) FILTER (WHERE b2 AND NOT b1) FROM f
    UNION ALL SELECT 3, 'order_number below 1', COUNT(*), COUNT(*) FILTER (WHERE b3),
      COUNT(*) FILTER (WHERE b3 AND NOT (b1 OR b2)) FROM f
    UNION ALL SELECT 4, 'order_dow outside 0-6', COUNT(*), COUNT(*) FILTER (WHERE b4),
      COUNT(*) FILTER (WHERE b4 AND NOT (b1 OR b2 OR b3)) FROM f
    UNION ALL SELECT 5, 'order_hour_of_day outside 0-23', COUNT(*), COUNT(*) FILTER (WHERE b5),
      COUNT(*) FILTER (WHERE b5 AND NOT (b1 OR b2 OR b3 OR b4)) FROM f
    UNION ALL SELECT 6, 'days_since_prior_order outside 0-30', COUNT(*), COUNT(*) FILTER (WHERE b6),
      COUNT(*) FILTER (WHERE b6 AND NOT (b1 OR b2 OR b3 OR b4 OR b5)) FROM f""",
)
def quality_report(spark, sf_dir):
    return quality.quality_report(dirty_orders(load_star(spark, sf_dir)), quality.order_rules())


@query("clean_aisles", "SELECT * FROM b_aisles")
def clean_aisles(spark, sf_dir):
    star = load_star(spark, sf_dir)
    # Every row doubled under a later name: one row per id is left.
    doubled = star.aisles.unionByName(star.aisles.withColumn("aisle", F.concat(F.lit("~"), "aisle")))
    return quality.clean_aisles(doubled)


@query("clean_departments", "SELECT * FROM b_departments")
def clean_departments(spark, sf_dir):
    star = load_star(spark, sf_dir)
    doubled = star.departments.unionByName(star.departments.withColumn("department", F.concat(F.lit("~"), "department")))
    return quality.clean_departments(doubled)


@query("clean_products", f", {DIRTY_PRODUCTS_SQL} SELECT * FROM c_products")
def clean_products(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return quality.clean_products(dirty_products(star), star.aisles, star.departments)


@query("clean_orders", f", {DIRTY_ORDERS_SQL} SELECT * FROM c_orders")
def clean_orders(spark, sf_dir):
    return quality.clean_orders(dirty_orders(load_star(spark, sf_dir)))


@query(
    "clean_order_products",
    f""", {DIRTY_ORDERS_SQL}, {DIRTY_PRODUCTS_SQL}, {DIRTY_LINES_SQL}
    SELECT * FROM d_lines WHERE order_id IN (SELECT order_id FROM c_orders)
      AND product_id IN (SELECT product_id FROM c_products) AND add_to_cart_order >= 1 AND reordered IN (0, 1)""",
)
def clean_order_products(spark, sf_dir):
    star = load_star(spark, sf_dir)
    orders = quality.clean_orders(dirty_orders(star))
    products = quality.clean_products(dirty_products(star), star.aisles, star.departments)
    return quality.clean_order_products(dirty_lines(star), orders, products)


@query(
    "fill_nulls",
    "SELECT order_id, user_id, COALESCE(days_since_prior_order, 0) AS days_since_prior_order FROM b_orders",
)
def fill_nulls(spark, sf_dir):
    orders = load_star(spark, sf_dir).orders.select("order_id", "user_id", "days_since_prior_order")
    return quality.fill_nulls(orders, {"days_since_prior_order": 0})


NA_SQL = """
n AS (SELECT order_id, CASE WHEN order_id % 9 = 0 THEN ' na ' WHEN order_id % 10 = 0 THEN 'NA'
  ELSE CAST(days_since_prior_order AS VARCHAR) END AS days, eval_set FROM b_orders)
"""


@query(
    "normalize_na",
    f""", {NA_SQL} SELECT CAST(order_id AS VARCHAR) AS order_id,
    CASE WHEN days IS NULL OR upper(trim(days)) = 'NA' THEN '' ELSE days END AS days, eval_set FROM n""",
)
def normalize_na(spark, sf_dir):
    oid = F.col("order_id")
    days = F.when(oid % 9 == 0, " na ").when(oid % 10 == 0, "NA").otherwise(F.col("days_since_prior_order").cast("string"))
    return quality.normalize_na(load_star(spark, sf_dir).orders.select("order_id", days.alias("days"), "eval_set"))


@query(
    "blank_to_null",
    f", {MIXED_SQL} SELECT order_id, NULLIF(raw_days, '') AS days_since_prior, raw_days AS other FROM m",
)
def blank_to_null(spark, sf_dir):
    df = mixed_days(load_star(spark, sf_dir)).select("order_id", F.col("raw_days").alias("days_since_prior"), F.col("raw_days").alias("other"))
    return quality.blank_to_null(df)


@query(
    "shape_order",
    """SELECT order_id, user_id, 'dummy streaming' AS eval_set, order_number, order_dow, order_hour_of_day,
    CAST(LEAST(COALESCE(CASE WHEN order_id % 5 = 0 THEN days_since_prior_order * 3 - 20 ELSE days_since_prior_order END, 0), 30) AS INT)
      AS days_since_prior FROM b_orders""",
)
def shape_order(spark, sf_dir):
    days = F.col("days_since_prior_order")
    stretched = F.when(F.col("order_id") % 5 == 0, days * 3 - 20).otherwise(days)
    return quality.shape_order(
        load_star(spark, sf_dir).orders.withColumn("days_since_prior", stretched).drop("days_since_prior_order", "eval_set")
    )


@query(
    "coerce_numeric",
    f", {MIXED_SQL} SELECT order_id, COALESCE(CAST(TRY_CAST(raw_days AS DOUBLE) AS BIGINT), 0) AS raw_days FROM m",
)
def coerce_numeric(spark, sf_dir):
    return quality.coerce_int(mixed_days(load_star(spark, sf_dir)), ["raw_days"])


@query(
    "type_report",
    """SELECT 'orders' AS table_name, 'user_id' AS column_name, 'bigint' AS data_type, CAST(MIN(user_id) AS VARCHAR) AS sample_value FROM b_orders
    UNION ALL SELECT 'orders', 'eval_set', 'string', MIN(eval_set) FROM b_orders
    UNION ALL SELECT 'orders', 'days_since_prior_order', 'int', CAST(MIN(days_since_prior_order) AS VARCHAR) FROM b_orders""",
)
def type_report(spark, sf_dir):
    return quality.type_report(load_star(spark, sf_dir).orders, "orders", ["user_id", "eval_set", "days_since_prior_order"])


@query(
    "filter_departments",
    """SELECT * FROM b_products WHERE department_id IN
    (SELECT department_id FROM b_departments WHERE department IN ('SMALL', 'PROMO'))""",
)
def filter_departments(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return quality.filter_departments(star.products, star.departments, ["SMALL", "PROMO"])


@query(
    "user_subset",
    "SELECT * FROM b_all WHERE order_id IN (SELECT order_id FROM b_orders WHERE user_id < 60)",
)
def user_subset(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return quality.user_subset(star.orders, joins.all_lines(star.prior, star.train), 60)[1]


@query(
    "valid_intervals",
    """SELECT CAST(days_since_prior_order AS DOUBLE) AS days FROM b_orders
    WHERE days_since_prior_order > 0 AND days_since_prior_order < 730""",
)
def valid_intervals(spark, sf_dir):
    return quality.valid_intervals(load_star(spark, sf_dir).orders, "days_since_prior_order")


CATALOG_SQL = """
cat AS (SELECT product_id, product_name, aisle_id, aisle, department_id, department FROM b_products
  LEFT JOIN b_aisles USING (aisle_id) LEFT JOIN b_departments USING (department_id))
"""


def catalog(star):
    return joins.product_catalog(star.products, star.aisles, star.departments)


@query(
    "product_document",
    f""", {CATALOG_SQL} SELECT product_id,
    'product name：' || product_name || '；aisle：' || aisle || '；department：' || department AS document FROM cat""",
)
def product_document(spark, sf_dir):
    from cartwheel.functions.text import product_document as document

    return catalog(load_star(spark, sf_dir)).select("product_id", document().alias("document"))


# -- joins and sets ----------------------------------------------------------------------------------------------

ORDER_COLUMNS = "order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, days_since_prior_order"


@query("combine", f"SELECT {ORDER_COLUMNS}, product_id, add_to_cart_order, reordered FROM b_orders JOIN b_all USING (order_id)")
def combine(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return joins.combine(star.orders, joins.all_lines(star.prior, star.train))


@query(
    "denormalize",
    f"""SELECT {ORDER_COLUMNS}, product_id, add_to_cart_order, reordered, product_name, aisle_id, department_id, aisle, department
    FROM b_orders JOIN b_all USING (order_id) JOIN b_products USING (product_id) JOIN b_aisles USING (aisle_id)
    JOIN b_departments USING (department_id)""",
)
def denormalize(spark, sf_dir):
    star = load_star(spark, sf_dir)
    lines = joins.all_lines(star.prior, star.train)
    return joins.denormalize(star.orders, lines, star.products, star.aisles, star.departments)


@query(
    "denormalize_left",
    f""", {DIRTY_LINES_SQL} SELECT {ORDER_COLUMNS}, product_id, add_to_cart_order, reordered, product_name, aisle_id,
    department_id, aisle, department FROM d_lines LEFT JOIN b_orders USING (order_id) LEFT JOIN b_products USING (product_id)
    LEFT JOIN b_departments USING (department_id) LEFT JOIN b_aisles USING (aisle_id)""",
)
def denormalize_left(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return joins.denormalize_left(dirty_lines(star), star.orders, star.products, star.aisles, star.departments)


@query(
    "fk_filter_small",
    f""", {DIRTY_PRODUCTS_SQL} SELECT * FROM d_products WHERE aisle_id IN (SELECT aisle_id FROM b_aisles)
    OR (SELECT COUNT(*) FILTER (WHERE aisle_id NOT IN (SELECT aisle_id FROM b_aisles)) >= 0.05 * COUNT(*) FROM d_products)""",
)
def fk_filter_small(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return joins.fk_filter_small(dirty_products(star), star.aisles, "aisle_id")[0]


@query(
    "fk_filter_large",
    f", {DIRTY_LINES_SQL} SELECT * FROM d_lines WHERE product_id IN (SELECT product_id FROM b_products)",
)
def fk_filter_large(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return joins.fk_filter_large(dirty_lines(star), star.products, "product_id")


@query("product_catalog", f", {CATALOG_SQL} SELECT * FROM cat")
def product_catalog(spark, sf_dir):
    return catalog(load_star(spark, sf_dir))


@query(
    "basket_pairs",
    """SELECT a.product_id AS product1_id, b.product_id AS product2_id, COUNT(*) AS pair_count
    FROM b_all a JOIN b_all b ON a.order_id = b.order_id AND a.product_id < b.product_id GROUP BY 1, 2""",
)
def basket_pairs(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return joins.basket_pairs(joins.all_lines(star.prior, star.train))


@query("lines_with_user", "SELECT user_id, b_all.* FROM b_all JOIN b_orders USING (order_id)")
def lines_with_user(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return joins.lines_with_user(joins.all_lines(star.prior, star.train), star.orders)


@query(
    "orphans",
    f""", {DIRTY_ORDERS_SQL} SELECT DISTINCT order_id FROM b_prior WHERE order_id NOT IN (SELECT order_id FROM c_orders)""",
)
def orphans(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return joins.orphans(star.prior, quality.clean_orders(dirty_orders(star)), "order_id")


@query("all_lines", "SELECT * FROM b_all")
def all_lines(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return joins.all_lines(star.prior, star.train)


@query("distinct_keys", "SELECT DISTINCT user_id FROM b_orders")
def distinct_keys(spark, sf_dir):
    return joins.distinct_keys(load_star(spark, sf_dir).orders, "user_id")


# -- features ----------------------------------------------------------------------------------------------------


def joined(star, lines):
    return joins.denormalize(star.orders, lines, star.products, star.aisles, star.departments)


@query(
    "user_features",
    """SELECT user_id, MAX(order_number) AS total_order_number,
    ROUND(AVG(COALESCE(days_since_prior_order, 0)), 6) AS avg_days_since_prior_order FROM b_orders GROUP BY 1""",
)
def user_features(spark, sf_dir):
    return rounded(features.user_features(load_star(spark, sf_dir).orders), "avg_days_since_prior_order")


def product_sql(lines: str) -> str:
    return f"""SELECT product_id, product_name,
    ROUND(CAST(SUM(reordered) AS DOUBLE) / COUNT(DISTINCT order_id), 6) AS reorder_rate_global,
    ROUND(AVG(add_to_cart_order), 6) AS avg_add_to_cart_order
    FROM {lines} JOIN b_orders USING (order_id) JOIN b_products USING (product_id) GROUP BY 1, 2"""


def upi_sql(lines: str) -> str:
    return f"""SELECT user_id, product_id, COUNT(order_id) AS total_orders,
    ROUND(AVG(add_to_cart_order), 6) AS avg_add_to_cart_order
    FROM {lines} JOIN b_orders USING (order_id) JOIN b_products USING (product_id) GROUP BY 1, 2"""


@query("product_features", product_sql("b_prior"))
def product_features(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return rounded(features.product_features(joined(star, star.prior)), "reorder_rate_global", "avg_add_to_cart_order")


@query("upi_features", upi_sql("b_prior"))
def upi_features(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return rounded(features.upi_features(joined(star, star.prior)), "avg_add_to_cart_order")


@query("product_features_union", product_sql("b_all"))
def product_features_union(spark, sf_dir):
    star = load_star(spark, sf_dir)
    df = features.product_features(joined(star, joins.all_lines(star.prior, star.train)))
    return rounded(df, "reorder_rate_global", "avg_add_to_cart_order")


@query("upi_features_union", upi_sql("b_all"))
def upi_features_union(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return rounded(features.upi_features(joined(star, joins.all_lines(star.prior, star.train))), "avg_add_to_cart_order")


@query(
    "interaction_features",
    """SELECT user_id, product_id, COUNT(*) AS upi_count, ROUND(AVG(days_since_prior_order), 6) AS upi_avg_interval
    FROM b_prior JOIN b_orders USING (order_id) GROUP BY 1, 2""",
)
def interaction_features(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return rounded(features.interaction_features(star.prior, star.orders), "upi_avg_interval")


@query(
    "ratings",
    """SELECT user_id, product_id, ROUND(1 + ln(1 + COUNT(*)), 6) AS rating
    FROM b_prior JOIN b_orders USING (order_id) GROUP BY 1, 2""",
)
def ratings(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return rounded(features.ratings(star.prior, star.orders), "rating")


@query(
    "purchase_counts",
    "SELECT user_id, product_id, COUNT(*) AS times_purchased FROM b_prior JOIN b_orders USING (order_id) GROUP BY 1, 2",
)
def purchase_counts(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return features.purchase_counts(star.prior, star.orders)


@query(
    "rating_stats",
    """SELECT COUNT(*) AS cnt, ROUND(MIN(rating), 6) AS min_rating, ROUND(MAX(rating), 6) AS max_rating,
    ROUND(AVG(rating), 6) AS avg_rating FROM (SELECT 1 + ln(1 + COUNT(*)) AS rating
    FROM b_prior JOIN b_orders USING (order_id) GROUP BY user_id, product_id) t""",
)
def rating_stats(spark, sf_dir):
    star = load_star(spark, sf_dir)
    stats = features.rating_stats(features.ratings(star.prior, star.orders))
    return rounded(stats, "min_rating", "max_rating", "avg_rating")


# -- windows and top lists ---------------------------------------------------------------------------------------


@query(
    "last_order",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY order_number DESC, order_id) AS rn
    FROM b_orders) t WHERE rn = 1""",
)
def last_order(spark, sf_dir):
    return ranking.last_order(load_star(spark, sf_dir).orders)


@query(
    "top_products",
    "SELECT product_id, COUNT(*) AS n_lines FROM b_train GROUP BY 1 ORDER BY n_lines DESC, product_id LIMIT 10",
)
def top_products(spark, sf_dir):
    return joins.top_products(load_star(spark, sf_dir).train, 10)


@query(
    "ecdf",
    """SELECT * FROM (SELECT value, n, ROUND(CAST(SUM(n) OVER (ORDER BY value) AS DOUBLE) / SUM(n) OVER (), 6) AS cdf FROM
    (SELECT CAST(days_since_prior_order AS DOUBLE) AS value, COUNT(*) AS n FROM b_orders
      WHERE days_since_prior_order > 0 GROUP BY 1) t) WHERE value <= 20""",
)
def ecdf(spark, sf_dir):
    days = quality.valid_intervals(load_star(spark, sf_dir).orders, "days_since_prior_order")
    return rounded(ranking.ecdf(days, "days", 20), "cdf")


@query(
    "random_users",
    """SELECT user_id FROM (SELECT DISTINCT user_id FROM b_orders) u
    ORDER BY md5('42:' || CAST(user_id AS VARCHAR)), user_id LIMIT 150""",
)
def random_users(spark, sf_dir):
    return ranking.random_users(joins.distinct_keys(load_star(spark, sf_dir).orders, "user_id"), 150)
