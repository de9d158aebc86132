"""Queries: commercial analytics."""

from __future__ import annotations

from cartwheel.operators import analytics, joins
from cartwheel.plans.inputs import DIRTY_ORDERS_SQL, dirty_orders, rounded
from cartwheel.plans.registry import query
from cartwheel.plans.star import load_star


def lines_of(star):
    return joins.all_lines(star.prior, star.train)


def affinity_sql(top_n: int, departments: tuple[str, ...] = ()) -> str:
    names = ", ".join(f"'{d}'" for d in departments)
    only = (
        f"WHERE p.department_id IN (SELECT department_id FROM b_departments WHERE department IN ({names}))" if names else ""
    )
    return f""", top AS (SELECT l.product_id FROM b_all l JOIN b_products p USING (product_id) {only}
      GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT {top_n}),
    x AS (SELECT l.* FROM b_all l JOIN top USING (product_id)),
    pairs AS (SELECT a.product_id AS product1_id, b.product_id AS product2_id, COUNT(*) AS pair_count
      FROM x a JOIN x b ON a.order_id = b.order_id AND a.product_id < b.product_id GROUP BY 1, 2)
    SELECT product1_id, p1.product_name AS product1_name, p1.department_id AS product1_department_id,
      d1.department AS product1_department, product2_id, p2.product_name AS product2_name,
      p2.department_id AS product2_department_id, d2.department AS product2_department, pair_count
    FROM pairs JOIN b_products p1 ON p1.product_id = product1_id JOIN b_products p2 ON p2.product_id = product2_id
    JOIN b_departments d1 ON d1.department_id = p1.department_id JOIN b_departments d2 ON d2.department_id = p2.department_id"""


@query("product_affinity", affinity_sql(20))
def product_affinity(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return analytics.product_affinity(lines_of(star), star.products, star.departments)


@query("product_affinity_departments", affinity_sql(50, ("SMALL", "PROMO")))
def product_affinity_departments(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return analytics.product_affinity(
        lines_of(star), star.products, star.departments, top_n=50, only_departments=["SMALL", "PROMO"]
    )


JOURNEY_SQL = """
om AS (SELECT order_id, user_id, COUNT(*) AS items, SUM(reordered) AS re, MAX(add_to_cart_order) AS size
  FROM b_orders JOIN b_all USING (order_id) GROUP BY 1, 2),
cm AS (SELECT user_id, COUNT(DISTINCT order_id) AS total_orders FROM om GROUP BY 1),
journey_o AS (SELECT COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT user_id) AS total_customers,
    CAST(SUM(CASE WHEN cm.total_orders = 1 THEN 1 ELSE 0 END) AS BIGINT) AS first_time_customers,
    CAST(SUM(CASE WHEN cm.total_orders > 1 THEN 1 ELSE 0 END) AS BIGINT) AS repeat_customers,
    CAST(SUM(items) AS BIGINT) AS total_items, CAST(SUM(re) AS BIGINT) AS reordered_items,
    CAST(SUM(items) - SUM(re) AS BIGINT) AS new_items,
    CAST(SUM(CASE WHEN size <= 5 THEN 1 ELSE 0 END) AS BIGINT) AS small_orders,
    CAST(SUM(CASE WHEN size > 5 AND size <= 15 THEN 1 ELSE 0 END) AS BIGINT) AS medium_orders,
    CAST(SUM(CASE WHEN size > 15 THEN 1 ELSE 0 END) AS BIGINT) AS large_orders
  FROM om JOIN cm USING (user_id)),
journey_c AS (SELECT * REPLACE (
    (SELECT COUNT(*) FROM cm WHERE total_orders = 1) AS first_time_customers,
    (SELECT COUNT(*) FROM cm WHERE total_orders > 1) AS repeat_customers) FROM journey_o)
"""


@query("journey_orders", f", {JOURNEY_SQL} SELECT * FROM journey_o")
def journey_orders(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return analytics.journey_orders(lines_of(star), star.orders)


@query("journey_customers", f", {JOURNEY_SQL} SELECT * FROM journey_c")
def journey_customers(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return analytics.journey_customers(lines_of(star), star.orders)


@query(
    "journey_kpis",
    f""", {JOURNEY_SQL} SELECT ROUND(repeat_customers * 100.0::DOUBLE / (first_time_customers + repeat_customers), 6) AS repeat_rate_pct,
    ROUND(reordered_items * 100.0::DOUBLE / total_items, 6) AS reorder_rate_pct,
    ROUND((small_orders * 3 + medium_orders * 10.5::DOUBLE + large_orders * 20)
      / (small_orders + medium_orders + large_orders), 6) AS avg_order_size_estimate,
    repeat_customers AS loyal_customers, ROUND(CAST(total_orders AS DOUBLE) / total_customers, 6) AS orders_per_customer
    FROM journey_c""",
)
def journey_kpis(spark, sf_dir):
    star = load_star(spark, sf_dir)
    kpis = analytics.journey_kpis(analytics.journey_customers(lines_of(star), star.orders))
    return rounded(kpis, "repeat_rate_pct", "reorder_rate_pct", "avg_order_size_estimate", "orders_per_customer")


LTV_SQL = """
cust AS (SELECT user_id, COUNT(DISTINCT order_id) AS total_orders, COUNT(*) AS total_items,
    CAST(SUM(reordered) AS BIGINT) AS total_reorders, AVG(CAST(add_to_cart_order AS DOUBLE)) AS avg_order_size,
    CAST(SUM(add_to_cart_order) AS BIGINT) AS cart, MAX(order_number) AS max_order_number
  FROM b_all JOIN b_orders USING (order_id) GROUP BY 1),
ltv AS (SELECT *, CASE WHEN total_orders >= 10 THEN 'High Value' WHEN total_orders >= 5 THEN 'Medium Value'
    ELSE 'Low Value' END AS customer_segment FROM cust)
"""


@query(
    "lifetime_value",
    f""", {LTV_SQL} SELECT user_id, total_orders, total_items, total_reorders, ROUND(avg_order_size, 6) AS avg_order_size,
    max_order_number, customer_segment FROM ltv""",
)
def lifetime_value(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return rounded(analytics.lifetime_value(lines_of(star), star.orders), "avg_order_size")


@query(
    "lifetime_value_true",
    f""", {LTV_SQL} SELECT user_id, total_orders, total_items, total_reorders, cart AS total_cart_additions,
    ROUND(CAST(total_items AS DOUBLE) / total_orders, 6) AS avg_order_size,
    ROUND(CAST(total_reorders AS DOUBLE) / total_items, 6) AS reorder_rate FROM cust""",
)
def lifetime_value_true(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return rounded(analytics.lifetime_value_true(lines_of(star), star.orders), "avg_order_size", "reorder_rate")


@query(
    "ltv_kpis",
    f""", {LTV_SQL} SELECT COUNT(*) FILTER (WHERE customer_segment = 'High Value') AS high_value,
    COUNT(*) FILTER (WHERE customer_segment = 'Medium Value') AS medium_value,
    COUNT(*) FILTER (WHERE customer_segment = 'Low Value') AS low_value,
    ROUND(AVG(total_orders), 6) AS avg_orders, ROUND(AVG(total_items), 6) AS avg_items,
    ROUND(AVG(CAST(total_reorders AS DOUBLE) / total_items) * 100, 6) AS avg_reorder_rate_pct,
    ROUND(AVG(avg_order_size), 6) AS avg_order_size FROM ltv""",
)
def ltv_kpis(spark, sf_dir):
    star = load_star(spark, sf_dir)
    kpis = analytics.ltv_kpis(analytics.lifetime_value(lines_of(star), star.orders, max_rows=None))
    return rounded(kpis, "avg_orders", "avg_items", "avg_reorder_rate_pct", "avg_order_size")


CHURN_SQL = """
churn AS (SELECT user_id, COUNT(DISTINCT order_id) AS total_orders,
    COALESCE(AVG(CAST(days_since_prior_order AS DOUBLE)), 0) AS avg_days_between,
    COALESCE(MAX(CAST(days_since_prior_order AS DOUBLE)), 0) AS max_days_between,
    COALESCE(stddev_samp(CAST(days_since_prior_order AS DOUBLE)), 0) AS std_days_between
  FROM b_orders WHERE order_number <> 1 GROUP BY 1)
"""
CHURN_COLUMNS = """user_id, total_orders, ROUND(avg_days_between, 6) AS avg_days_between,
    ROUND(max_days_between, 6) AS max_days_between, ROUND(std_days_between, 6) AS std_days_between"""


def churn_rounded(df):
    return rounded(df, "avg_days_between", "max_days_between", "std_days_between")


@query("churn_indicators", f", {CHURN_SQL} SELECT {CHURN_COLUMNS} FROM churn")
def churn_indicators(spark, sf_dir):
    return churn_rounded(analytics.churn_indicators(load_star(spark, sf_dir).orders))


@query(
    "churn_timeline",
    f""", steps AS (SELECT user_id, order_number, MIN_BY(days_since_prior_order, order_id) AS days
      FROM b_all JOIN b_orders USING (order_id) GROUP BY 1, 2),
    churn AS (SELECT user_id, MAX(order_number) AS total_orders, COALESCE(AVG(CAST(days AS DOUBLE)), 0) AS avg_days_between,
      COALESCE(MAX(CAST(days AS DOUBLE)), 0) AS max_days_between,
      COALESCE(stddev_samp(CAST(days AS DOUBLE)), 0) AS std_days_between FROM steps GROUP BY 1)
    SELECT {CHURN_COLUMNS} FROM churn""",
)
def churn_timeline(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return churn_rounded(analytics.churn_timeline(joins.combine(star.orders, lines_of(star))))


@query(
    "churn_kpis",
    f""", {CHURN_SQL} SELECT COUNT(*) FILTER (WHERE avg_days_between > 14) AS high_risk_avg,
    ROUND(AVG(avg_days_between), 6) AS avg_days, COUNT(*) FILTER (WHERE max_days_between > 30) AS high_risk_max,
    ROUND(AVG(total_orders), 6) AS avg_orders FROM churn""",
)
def churn_kpis(spark, sf_dir):
    churn = analytics.churn_indicators(load_star(spark, sf_dir).orders)
    return rounded(analytics.churn_kpis(churn), "avg_days", "avg_orders")


@query(
    "high_risk",
    f", {CHURN_SQL} SELECT {CHURN_COLUMNS} FROM churn WHERE churn.avg_days_between > 14 ORDER BY ROUND(churn.avg_days_between, 9) DESC, user_id LIMIT 10",
)
def high_risk(spark, sf_dir):
    churn = analytics.churn_indicators(load_star(spark, sf_dir).orders)
    return churn_rounded(analytics.high_risk(churn))


def summary_sql(departments: tuple[str, ...] = ()) -> str:
    names = ", ".join(f"'{d}'" for d in departments)
    pick = f"WHERE department IN ({names})" if names else ""
    return f""", fd AS (SELECT * FROM b_departments {pick}),
    fp AS (SELECT * FROM b_products WHERE department_id IN (SELECT department_id FROM fd)),
    fl AS (SELECT * FROM b_all WHERE product_id IN (SELECT product_id FROM fp)),
    summary AS (SELECT 'Total Users' AS metric, COUNT(DISTINCT user_id) AS value FROM b_orders
      WHERE order_id IN (SELECT order_id FROM fl)
    UNION ALL SELECT 'Total Orders', COUNT(DISTINCT order_id) FROM fl
    UNION ALL SELECT 'Total Products', COUNT(DISTINCT product_id) FROM fp
    UNION ALL SELECT 'Total Items', COUNT(*) FROM fl
    UNION ALL SELECT 'Total Departments', COUNT(DISTINCT department_id) FROM fd
    UNION ALL SELECT 'Total Aisles', COUNT(DISTINCT aisle_id) FROM b_aisles)"""


def summary(star, departments=None):
    return analytics.data_summary(
        lines_of(star), star.orders, star.products, star.departments, star.aisles, departments
    )


@query("data_summary", f"{summary_sql()} SELECT * FROM summary")
def data_summary(spark, sf_dir):
    return summary(load_star(spark, sf_dir))


@query("data_summary_departments", f"{summary_sql(('SMALL', 'LARGE'))} SELECT * FROM summary")
def data_summary_departments(spark, sf_dir):
    return summary(load_star(spark, sf_dir), ["SMALL", "LARGE"])


@query(
    "summary_share",
    f"""{summary_sql()} SELECT metric AS "Metric", value AS "Count",
    ROUND(CAST(value AS DOUBLE) / (SELECT SUM(value) FROM summary), 4) AS "Share" FROM summary""",
)
def summary_share(spark, sf_dir):
    return analytics.summary_share(summary(load_star(spark, sf_dir)))


@query(
    "summary_averages",
    f"""{summary_sql()} SELECT ROUND(CAST(i.value AS DOUBLE) / o.value, 6) AS items_per_order,
    ROUND(CAST(o.value AS DOUBLE) / u.value, 6) AS orders_per_user
    FROM summary i, summary o, summary u WHERE i.metric = 'Total Items' AND o.metric = 'Total Orders' AND u.metric = 'Total Users'""",
)
def summary_averages(spark, sf_dir):
    return rounded(analytics.summary_averages(summary(load_star(spark, sf_dir))), "items_per_order", "orders_per_user")


@query(
    "popular_products",
    """SELECT product_id, product_name, aisle, department, COUNT(*) AS purchase_count FROM b_prior
    JOIN b_products USING (product_id) LEFT JOIN b_aisles USING (aisle_id) LEFT JOIN b_departments USING (department_id)
    GROUP BY 1, 2, 3, 4 ORDER BY purchase_count DESC, product_id LIMIT 20""",
)
def popular_products(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return analytics.popular_products(star.prior, star.products, star.aisles, star.departments)


@query(
    "order_count_distribution",
    f", {LTV_SQL} SELECT total_orders, COUNT(*) AS customers FROM cust GROUP BY 1",
)
def order_count_distribution(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return analytics.order_count_distribution(lines_of(star), star.orders)


@query(
    "interaction_report",
    f""", {DIRTY_ORDERS_SQL}, j AS (SELECT user_id, product_id FROM b_prior JOIN c_orders USING (order_id))
    SELECT (SELECT COUNT(*) FROM c_orders) AS order_rows, (SELECT COUNT(DISTINCT user_id) FROM c_orders) AS users,
    (SELECT COUNT(DISTINCT order_id) FROM c_orders) AS orders, (SELECT COUNT(*) FROM c_orders WHERE user_id IS NULL) AS null_users,
    COUNT(*) AS line_rows, COUNT(DISTINCT product_id) AS products, COUNT(*) FILTER (WHERE product_id IS NULL) AS null_products,
    COUNT(*) FILTER (WHERE order_id IS NULL) AS null_orders,
    (SELECT COUNT(DISTINCT order_id) FROM b_prior WHERE order_id NOT IN (SELECT order_id FROM c_orders)) AS orphan_orders,
    (SELECT COUNT(*) FROM j) AS interactions, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM j) d) AS user_product_pairs
    FROM b_prior""",
)
def interaction_report(spark, sf_dir):
    from cartwheel.operators.quality import clean_orders

    star = load_star(spark, sf_dir)
    return analytics.interaction_report(clean_orders(dirty_orders(star)), star.prior)


@query("departments_list", "SELECT * FROM b_departments ORDER BY department")
def departments_list(spark, sf_dir):
    return analytics.departments_list(load_star(spark, sf_dir).departments)


@query("ordered_lines", "SELECT b_all.*, user_id, order_number FROM b_all JOIN b_orders USING (order_id)")
def ordered_lines(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return analytics.ordered_lines(lines_of(star), star.orders)
