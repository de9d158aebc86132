"""Commercial questions: affinity, journey, lifetime value, churn, summaries.

Lines are folded to one row per order before anything else, so customer totals come from two cheap aggregations
instead of a join of lines with themselves, and a heavy order or customer shrinks before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.operators import joins, quality

# Customer classes and order sizes.
HIGH_ORDERS, MEDIUM_ORDERS = 10, 5
SMALL_ORDER, MEDIUM_ORDER = 5, 15
ORDER_SIZE_ESTIMATE = (3.0, 10.5, 20.0)
RISK_AVG_DAYS, RISK_MAX_DAYS = 14, 30


def product_affinity(
    lines: DataFrame,
    products: DataFrame,
    departments: DataFrame,
    top_n: int = 20,
    only_departments: Sequence[str] | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Pairs among the top products bought in the same order; the ``max_rows`` most frequent ones if that is given."""
    eligible = quality.filter_departments(products, departments, only_departments).select("product_id")
    candidates = lines.join(eligible, "product_id", "left_semi")
    pairs = joins.basket_pairs(joins.restrict_top(candidates, top_n))
    named = products.join(departments, "department_id").select(
        "product_id", "product_name", "department_id", "department"
    )

    def side(n: int) -> DataFrame:
        return named.select(*[F.col(c).alias(f"product{n}_{c.removeprefix('product_')}") for c in named.columns])

    named_pairs = (
        pairs.join(side(1), "product1_id")
        .join(side(2), "product2_id")
        .select(
            *[f"product{n}_{c}" for n in (1, 2) for c in ("id", "name", "department_id", "department")], "pair_count"
        )
    )
    if max_rows is None:
        return named_pairs
    return named_pairs.orderBy(F.desc("pair_count"), "product1_id", "product2_id").limit(max_rows)


def order_totals(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order that has lines. ``orders`` holds an order once."""
    folded = lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(F.col("reordered") == 1).alias("reordered_items"),
        F.max("add_to_cart_order").alias("order_size"),
        F.sum("add_to_cart_order").alias("cart_sum"),
        F.count("add_to_cart_order").alias("cart_rows"),
    )
    return folded.join(orders.select("order_id", "user_id", "order_number"), "order_id")


def customer_totals(lines: DataFrame, orders: DataFrame) -> DataFrame:
    size = F.col("order_size")
    return (
        order_totals(lines, orders)
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("items").alias("total_items"),
            F.sum("reordered_items").alias("total_reorders"),
            F.sum("cart_sum").alias("cart_sum"),
            F.sum("cart_rows").alias("cart_rows"),
            F.max("order_number").alias("max_order_number"),
            F.count_if(size <= SMALL_ORDER).alias("small_orders"),
            F.count_if((size > SMALL_ORDER) & (size <= MEDIUM_ORDER)).alias("medium_orders"),
            F.count_if(size > MEDIUM_ORDER).alias("large_orders"),
        )
    )


def _journey(customers: DataFrame, weight: Column) -> DataFrame:
    def total(name: str, alias: str | None = None) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(alias or name)

    one = F.col("total_orders") == 1
    return customers.agg(
        total("total_orders"),
        F.count(F.lit(1)).alias("total_customers"),
        F.coalesce(F.sum(F.when(one, weight)), F.lit(0)).alias("first_time_customers"),
        F.coalesce(F.sum(F.when(~one, weight)), F.lit(0)).alias("repeat_customers"),
        total("total_items"),
        total("total_reorders", "reordered_items"),
        F.coalesce(F.sum(F.col("total_items") - F.col("total_reorders")), F.lit(0)).alias("new_items"),
        total("small_orders"),
        total("medium_orders"),
        total("large_orders"),
    )


def journey_orders(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Journey totals where customer classes count one per order."""
    return _journey(customer_totals(lines, orders), F.col("total_orders"))


def journey_customers(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Journey totals where customer classes count each customer once."""
    return _journey(customer_totals(lines, orders), F.lit(1).cast("long"))


def journey_kpis(journey: DataFrame) -> DataFrame:
    classes = F.col("first_time_customers") + F.col("repeat_customers")
    sized = F.col("small_orders") + F.col("medium_orders") + F.col("large_orders")
    small, medium, large = ORDER_SIZE_ESTIMATE
    estimate = F.col("small_orders") * small + F.col("medium_orders") * medium + F.col("large_orders") * large
    return journey.select(
        F.try_divide(F.col("repeat_customers") * 100.0, classes).alias("repeat_rate_pct"),
        F.try_divide(F.col("reordered_items") * 100.0, F.col("total_items")).alias("reorder_rate_pct"),
        F.try_divide(estimate, sized).alias("avg_order_size_estimate"),
        F.col("repeat_customers").alias("loyal_customers"),
        F.try_divide(F.col("total_orders").cast("double"), F.col("total_customers")).alias("orders_per_customer"),
    )


def _value_class() -> Column:
    return (
        F.when(F.col("total_orders") >= HIGH_ORDERS, "High Value")
        .when(F.col("total_orders") >= MEDIUM_ORDERS, "Medium Value")
        .otherwise("Low Value")
    )


def lifetime_value(lines: DataFrame, orders: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Totals per customer; ``avg_order_size`` is the mean cart position."""
    out = customer_totals(lines, orders).select(
        "user_id",
        "total_orders",
        "total_items",
        "total_reorders",
        (F.col("cart_sum") / F.col("cart_rows")).alias("avg_order_size"),
        "max_order_number",
        _value_class().alias("customer_segment"),
    )
    return out if max_rows is None else out.orderBy(F.desc("total_items"), "user_id").limit(max_rows)


def lifetime_value_true(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Totals per customer with items per order and the reorder rate."""
    return customer_totals(lines, orders).select(
        "user_id",
        "total_orders",
        "total_items",
        "total_reorders",
        F.col("cart_sum").alias("total_cart_additions"),
        F.coalesce(F.try_divide(F.col("total_items"), F.col("total_orders")), F.lit(0.0)).alias("avg_order_size"),
        F.coalesce(F.try_divide(F.col("total_reorders"), F.col("total_items")), F.lit(0.0)).alias("reorder_rate"),
    )


def ltv_kpis(values: DataFrame) -> DataFrame:
    """One row over ``lifetime_value`` rows."""
    segment = F.col("customer_segment")
    return values.agg(
        F.count_if(segment == "High Value").alias("high_value"),
        F.count_if(segment == "Medium Value").alias("medium_value"),
        F.count_if(segment == "Low Value").alias("low_value"),
        F.avg("total_orders").alias("avg_orders"),
        F.avg("total_items").alias("avg_items"),
        (F.avg(F.col("total_reorders") / F.col("total_items")) * 100).alias("avg_reorder_rate_pct"),
        F.avg("avg_order_size").alias("avg_order_size"),
    )


def _gap_stats(df: DataFrame, total: Column) -> DataFrame:
    days = F.col("days_since_prior_order").cast("double")

    def filled(value: Column, name: str) -> Column:
        return F.coalesce(value, F.lit(0.0)).alias(name)

    return df.groupBy("user_id").agg(
        total.alias("total_orders"),
        filled(F.avg(days), "avg_days_between"),
        filled(F.max(days), "max_days_between"),
        filled(F.stddev_samp(days), "std_days_between"),
    )


def churn_indicators(orders: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Gap statistics per customer without first orders."""
    out = _gap_stats(orders.filter("order_number <> 1"), F.countDistinct("order_id"))
    return out if max_rows is None else out.orderBy("user_id").limit(max_rows)


def churn_timeline(joined: DataFrame) -> DataFrame:
    """Gap statistics per customer from lines with their orders; the first row per order number counts."""
    known = F.col("days_since_prior_order").isNotNull()
    steps = joined.groupBy("user_id", "order_number").agg(
        F.min_by("days_since_prior_order", F.when(known, F.col("order_id"))).alias("days_since_prior_order")
    )
    return _gap_stats(steps, F.max("order_number"))


def churn_kpis(churn: DataFrame) -> DataFrame:
    return churn.agg(
        F.count_if(F.col("avg_days_between") > RISK_AVG_DAYS).alias("high_risk_avg"),
        F.avg("avg_days_between").alias("avg_days"),
        F.count_if(F.col("max_days_between") > RISK_MAX_DAYS).alias("high_risk_max"),
        F.avg("total_orders").alias("avg_orders"),
    )


def high_risk(churn: DataFrame, n: int = 10, by: str = "avg_days_between", above: float = RISK_AVG_DAYS) -> DataFrame:
    """The ``n`` customers whose indicator exceeds the limit most."""
    return churn.filter(F.col(by) > above).orderBy(F.desc(F.round(by, 9)), "user_id").limit(n)


def data_summary(
    lines: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    departments: DataFrame,
    aisles: DataFrame,
    only_departments: Sequence[str] | None = None,
) -> DataFrame:
    """Six (metric, value) rows; the number of aisles ignores the department filter."""
    kept_products = quality.filter_departments(products, departments, only_departments)
    kept_departments = departments
    if only_departments and quality.ALL_DEPARTMENTS not in only_departments:
        kept_departments = departments.filter(F.col("department").isin(list(only_departments)))
    per_order = (
        lines.join(kept_products.select("product_id"), "product_id")
        .groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("items"))
        .join(joins.order_users(orders), "order_id", "left")
    )
    facts = per_order.agg(
        F.countDistinct("user_id").alias("users"),
        F.count("order_id").alias("orders"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("items"),
    )

    def distinct(df: DataFrame, key: str) -> Column:
        return df.agg(F.countDistinct(key)).scalar()

    metrics = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), value.cast("long").alias("value"))
            for name, value in (
                ("Total Users", F.col("users")),
                ("Total Orders", F.col("orders")),
                ("Total Products", distinct(kept_products, "product_id")),
                ("Total Items", F.col("items")),
                ("Total Departments", distinct(kept_departments, "department_id")),
                ("Total Aisles", distinct(aisles, "aisle_id")),
            )
        ]
    )
    return facts.select(F.explode(metrics).alias("m")).select("m.metric", "m.value")


def summary_share(summary: DataFrame) -> DataFrame:
    """Share of each metric in the sum of all, largest first."""
    total = summary.agg(F.sum("value")).scalar()
    return summary.select(
        F.col("metric").alias("Metric"),
        F.col("value").alias("Count"),
        F.round(F.col("value") / total, 4).alias("Share"),
    ).orderBy(F.desc("Count"), "Metric")


def summary_averages(summary: DataFrame) -> DataFrame:
    def value(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col("value")))

    return summary.agg(
        value("Total Items").alias("items"), value("Total Orders").alias("orders"), value("Total Users").alias("users")
    ).select(
        F.coalesce(F.try_divide("items", "orders"), F.lit(0.0)).alias("items_per_order"),
        F.coalesce(F.try_divide("orders", "users"), F.lit(0.0)).alias("orders_per_user"),
    )


def popular_products(prior: DataFrame, products: DataFrame, aisles: DataFrame, departments: DataFrame, n: int = 20) -> DataFrame:
    """Top ``n`` catalog products by prior lines; counted and cut before the dimensions are joined."""
    known = prior.join(products.select("product_id"), "product_id", "left_semi")
    top = joins.top_products(known, n)
    catalog = joins.product_catalog(products, aisles, departments)
    return (
        F.broadcast(top)
        .join(catalog, "product_id")
        .select("product_id", "product_name", "aisle", "department", F.col("n_lines").alias("purchase_count"))
        .orderBy(F.desc("purchase_count"), "product_id")
    )


def order_count_distribution(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers per number of orders."""
    return (
        customer_totals(lines, orders).groupBy("total_orders").agg(F.count(F.lit(1)).alias("customers"))
    )


def interaction_report(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Row counts, distinct keys, missing keys and orphan orders of the training input, in one row."""
    order_side = orders.agg(
        F.count(F.lit(1)).alias("order_rows"),
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("order_id").alias("orders"),
        F.count_if(F.col("user_id").isNull()).alias("null_users"),
    )
    line_side = lines.agg(
        F.count(F.lit(1)).alias("line_rows"),
        F.countDistinct("product_id").alias("products"),
        F.count_if(F.col("product_id").isNull()).alias("null_products"),
        F.count_if(F.col("order_id").isNull()).alias("null_orders"),
    )
    missing = joins.orphans(lines.filter("order_id IS NOT NULL"), orders, "order_id").agg(F.count(F.lit(1)))
    pairs = (
        lines.join(orders.select("order_id", "user_id"), "order_id")
        .groupBy("user_id", "product_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.struct(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("pairs")))
    ).scalar()
    lines_row = line_side.select(F.struct(*line_side.columns)).scalar()
    return order_side.select(
        "*",
        *[lines_row[c].alias(c) for c in line_side.columns],
        missing.scalar().alias("orphan_orders"),
        pairs["rows"].alias("interactions"),
        pairs["pairs"].alias("user_product_pairs"),
    )


def departments_list(departments: DataFrame) -> DataFrame:
    return departments.select("department_id", "department").orderBy("department")


def ordered_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines by user, order number and cart position (a range-partitioned sort)."""
    placed = lines.join(orders.select("order_id", "user_id", "order_number"), "order_id")
    return placed.orderBy("user_id", "order_number", "order_id", "add_to_cart_order", "product_id")
