"""Data-quality rules and the cleaning of the five base tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.session import stored

# Fixed values of the order domain.
EVAL_SETS = ("prior", "train", "test")
MAX_RARE_SHARE = 0.05
ALL_DEPARTMENTS = "All Departments"
STREAM_EVAL_SET = "dummy streaming"
ORDER_RECORD = (
    "order_id",
    "user_id",
    "eval_set",
    "order_number",
    "order_dow",
    "order_hour_of_day",
    "days_since_prior",
)


@dataclass(frozen=True)
class Rule:
    """``bad`` marks failing rows; ``keep`` (default: not bad) is what survives when the rule is applied."""

    name: str
    bad: Column
    keep: Column | None = None

    @property
    def kept(self) -> Column:
        return ~self.bad if self.keep is None else self.keep


# -- checks: TRUE for a failing row, never NULL ------------------------------------------------------------------


def not_int(name: str) -> Column:
    return F.col(name).try_cast("int").isNull()


def is_blank(name: str) -> Column:
    return F.col(name).isNull() | (F.coalesce(F.col(name), F.lit("")) == "")


def outside_domain(name: str, values: Iterable) -> Column:
    return ~F.coalesce(F.col(name).isin(list(values)), F.lit(False))


def outside_range(name: str, lo: int | None = None, hi: int | None = None, nullable: bool = False) -> Column:
    value = F.col(name).try_cast("int")
    inside = F.lit(True)
    if lo is not None:
        inside = inside & (value >= lo)
    if hi is not None:
        inside = inside & (value <= hi)
    inside = F.coalesce(inside & value.isNotNull(), F.lit(False))
    if nullable:
        inside = inside | F.col(name).isNull()
    return ~inside


# -- duplicates, reports, pruning --------------------------------------------------------------------------------


def drop_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by all remaining columns. Combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    smallest = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return smallest.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """Number of rows whose key occurs more than once, and of such keys."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("duplicate_rows"),
        F.count(F.lit(1)).alias("duplicate_keys"),
    )


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per rule: rows failing it, and rows that pass all earlier rules but fail it. One pass over the data."""
    measures, passed = [], F.lit(True)
    for i, rule in enumerate(rules):
        measures.append(F.count_if(rule.bad).alias(f"f{i}"))
        measures.append(F.count_if(passed & rule.bad).alias(f"r{i}"))
        passed = passed & ~rule.bad
    totals = df.agg(F.count(F.lit(1)).alias("rows"), *measures)
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("step"),
                F.lit(rule.name).alias("rule"),
                F.col("rows").alias("total_rows"),
                F.col(f"f{i}").alias("failing"),
                F.col(f"r{i}").alias("removed"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return totals.select(F.inline(rows))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    for rule in rules:
        df = df.filter(rule.kept)
    return df


def prune_if_rare(df: DataFrame, rules: Sequence[Rule], max_share: float = MAX_RARE_SHARE) -> tuple[DataFrame, DataFrame]:
    """Apply each rule only if it fails for less than ``max_share`` of the rows left by the rules before it.

    Returns the kept rows and a report (rule, total, bad, dropped), both lazy: rows are counted once per combination of
    rule outcomes, at most 4 ** rules groups, and the decisions taken on that one array reach the filter as a scalar
    subquery.
    """
    flags = [c for i, r in enumerate(rules) for c in (r.bad.alias(f"b{i}"), r.kept.alias(f"k{i}"))]
    groups = df.select(*flags).groupBy(*[f"{f}{i}" for i in range(len(rules)) for f in "bk"]).agg(F.count(F.lit(1)).alias("n"))
    state = groups.agg(F.collect_list(F.struct(*groups.columns)).alias("left"))

    def field(name: str):
        return lambda g: g[name]

    def rows(groups: Column) -> Column:
        return F.aggregate(groups, F.lit(0).cast("long"), lambda total, g: total + g["n"])

    for i in range(len(rules)):
        state = state.withColumns({f"total{i}": rows(F.col("left")), f"bad{i}": rows(F.filter("left", field(f"b{i}")))})
        state = state.withColumn(f"dropped{i}", (F.col(f"total{i}") > 0) & (F.col(f"bad{i}") / F.col(f"total{i}") < max_share))
        state = state.withColumn("left", F.when(F.col(f"dropped{i}"), F.filter("left", field(f"k{i}"))).otherwise(F.col("left")))
    report = state.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(rule.name).alias("rule"), F.col(f"total{i}").alias("total"), F.col(f"bad{i}").alias("bad"),
                        F.col(f"dropped{i}").alias("dropped"),
                    )
                    for i, rule in enumerate(rules)
                ]
            )
        )
    )
    decided = state.select(F.array(*[F.col(f"dropped{i}") for i in range(len(rules))])).scalar()
    kept = F.lit(True)
    for i, rule in enumerate(rules):
        kept = kept & (~decided[i] | rule.kept)
    return df.where(kept), report


def prune_once(df: DataFrame, rules: Sequence[Rule], max_share: float = MAX_RARE_SHARE) -> tuple[DataFrame, DataFrame]:
    """The rows and report of ``prune_if_rare``, for an input that costs shuffles or joins.

    The input is worked out once, into a stored copy with the outcomes of the rules as the bits of one number. One job
    counts its rows per number, at most 4 ** rules rows; what the rules decide on these counts becomes a plain filter
    over the copy. ``prune_if_rare`` starts no job but plans its input twice.
    """
    spark, outcome = df.sparkSession, "_outcome"
    while outcome in df.columns:
        outcome += "_"
    bits = [F.when(c, F.lit(1 << n)).otherwise(F.lit(0)) for n, c in enumerate(c for r in rules for c in (r.bad, r.kept))]
    judged = stored(df.withColumn(outcome, reduce(add, bits, F.lit(0))), "judged")
    left = {r[0]: r[1] for r in judged.groupBy(outcome).count().collect()}

    found, needed = [], 0
    for i, rule in enumerate(rules):
        bad, kept = 1 << 2 * i, 2 << 2 * i
        total, failing = sum(left.values()), sum(n for seen, n in left.items() if seen & bad)
        dropped = total > 0 and failing / total < max_share
        if dropped:
            left, needed = {seen: n for seen, n in left.items() if seen & kept}, needed | kept
        found.append((rule.name, total, failing, dropped))
    report = spark.createDataFrame(found, "rule string, total long, bad long, dropped boolean")
    return judged.where(F.col(outcome).bitwiseAND(needed) == needed).select(*df.columns), report


# -- cleaning pipelines ------------------------------------------------------------------------------------------


def clean_dimension(df: DataFrame, key: str, name: str) -> DataFrame:
    rules = [Rule(f"{key} not an integer", not_int(key)), Rule(f"{name} blank", is_blank(name))]
    return prune_once(drop_duplicates(df, [key]), rules)[0]


def clean_aisles(aisles: DataFrame) -> DataFrame:
    return clean_dimension(aisles, "aisle_id", "aisle")


def clean_departments(departments: DataFrame) -> DataFrame:
    return clean_dimension(departments, "department_id", "department")


def foreign_key_rule(df: DataFrame, parent: DataFrame, key: str) -> tuple[DataFrame, Rule, str]:
    """Flag rows whose key is in the parent. A NULL key is not counted as bad but goes when the rule applies."""
    flag = f"_known_{key}"
    known = parent.select(F.col(key).try_cast("int").alias(key)).distinct().withColumn(flag, F.lit(True))
    cast = F.col(key).try_cast("int")
    joined = df.withColumn("_fk", cast).join(known.withColumnRenamed(key, "_fk"), "_fk", "left").drop("_fk")
    found = F.coalesce(F.col(flag), F.lit(False))
    return joined, Rule(f"{key} not in parent", cast.isNotNull() & ~found, keep=found), flag


def clean_products(products: DataFrame, aisles: DataFrame, departments: DataFrame) -> DataFrame:
    """``aisles`` and ``departments`` are the cleaned tables."""
    return clean_products_report(products, aisles, departments)[0]


def clean_products_report(
    products: DataFrame, aisles: DataFrame, departments: DataFrame
) -> tuple[DataFrame, DataFrame]:
    df = drop_duplicates(products, ["product_id"])
    df, aisle_rule, aisle_flag = foreign_key_rule(df, aisles, "aisle_id")
    df, department_rule, department_flag = foreign_key_rule(df, departments, "department_id")
    rules = [
        Rule("product_id not an integer", not_int("product_id")),
        Rule("product_name blank", is_blank("product_name")),
        aisle_rule,
        department_rule,
    ]
    kept, report = prune_once(df, rules)
    return kept.drop(aisle_flag, department_flag).select(*products.columns), report


ORDER_RULES = (
    ("user_id not an integer", lambda: not_int("user_id")),
    ("eval_set unknown", lambda: outside_domain("eval_set", EVAL_SETS)),
    ("order_number below 1", lambda: outside_range("order_number", 1)),
    ("order_dow outside 0-6", lambda: outside_range("order_dow", 0, 6)),
    ("order_hour_of_day outside 0-23", lambda: outside_range("order_hour_of_day", 0, 23)),
    ("days_since_prior_order outside 0-30", lambda: outside_range("days_since_prior_order", 0, 30, nullable=True)),
)
LINE_RULES = (
    ("add_to_cart_order below 1", lambda: outside_range("add_to_cart_order", 1)),
    ("reordered not 0 or 1", lambda: outside_range("reordered", 0, 1)),
)


def order_rules() -> list[Rule]:
    return [Rule(name, bad()) for name, bad in ORDER_RULES]


def line_rules() -> list[Rule]:
    return [Rule(name, bad()) for name, bad in LINE_RULES]


def clean_orders(orders: DataFrame) -> DataFrame:
    with_id = orders.filter(~not_int("order_id"))
    return apply_rules(drop_duplicates(with_id, ["order_id"]), order_rules())


def clean_order_products(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Lines of known orders and products with valid cart position and reorder flag; NULL keys go."""
    valid = apply_rules(lines, line_rules())
    known_product = valid.join(products.select("product_id"), "product_id", "left_semi")
    known = known_product.join(orders.select("order_id"), "order_id", "left_semi")
    return known.select(*lines.columns)


# -- value shaping -----------------------------------------------------------------------------------------------


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


def normalize_na(df: DataFrame) -> DataFrame:
    """NULL and the text NA (any case, blanks around it) become empty strings in every column."""
    def clean(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.when(text.isNull() | (F.upper(F.trim(text)) == "NA"), "").otherwise(text).alias(name)

    return df.select(*[clean(c) for c in df.columns])


BLANK_AS_NULL = ("day_since_prior_order", "days_since_prior")


def blank_to_null(df: DataFrame, columns: Sequence[str] = BLANK_AS_NULL) -> DataFrame:
    lowered = {c.lower() for c in columns}
    return df.select(
        *[F.nullif(F.col(c), F.lit("")).alias(c) if c.lower() in lowered else F.col(c) for c in df.columns]
    )


def shape_order(df: DataFrame, eval_set: str = STREAM_EVAL_SET) -> DataFrame:
    """Stream record shape: missing gap is 0, gaps above 30 are 30, negative gaps stay; fixed column order."""
    days = F.least(F.coalesce("days_since_prior", F.lit(0)), F.lit(30))
    shaped = df.withColumn("days_since_prior", days).withColumn("eval_set", F.lit(eval_set))
    extra = [c for c in df.columns if c not in ORDER_RECORD]
    return shaped.select(*extra, *ORDER_RECORD)


def coerce_int(df: DataFrame, columns: Sequence[str], default: int = 0) -> DataFrame:
    """Whole numbers from loosely typed columns, ``default`` where the text is no number."""
    number = {c: F.coalesce(F.col(c).try_cast("double").try_cast("long"), F.lit(default)) for c in columns}
    return df.withColumns(number)


def numeric_or_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn text columns into numbers where every value parses; a column with any other text stays as it is."""
    def number(name: str) -> Column:
        return F.col(name).try_cast("double")

    checks = [F.bool_and(F.col(c).isNull() | number(c).isNotNull()).alias(f"{c}_parsed") for c in columns]
    checks += [F.bool_and(number(c) == F.floor(number(c))).alias(f"{c}_whole") for c in columns]
    seen = df.agg(*checks).first()
    target = {c: "bigint" if seen[f"{c}_whole"] else "double" for c in columns if seen[f"{c}_parsed"]}
    return df.withColumns({c: number(c).try_cast(t) for c, t in target.items()})


def type_report(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Type and smallest value of each column, as text."""
    sample = df.agg(*[F.min(c).alias(c) for c in columns])
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.typeof(c).alias("data_type"),
                F.col(c).cast("string").alias("sample_value"),
            )
            for c in columns
        ]
    )
    return sample.select(F.inline(rows))


def filter_departments(products: DataFrame, departments: DataFrame, names: Sequence[str] | None) -> DataFrame:
    """Products of the named departments; no names or 'All Departments' means no restriction."""
    if not names or ALL_DEPARTMENTS in names:
        return products
    wanted = departments.filter(F.col("department").isin(list(names))).select("department_id")
    return products.join(wanted, "department_id", "left_semi").select(*products.columns)


def user_subset(orders: DataFrame, lines: DataFrame, max_user: int) -> tuple[DataFrame, DataFrame]:
    """Orders of users below ``max_user`` and the lines of those orders."""
    kept = orders.filter(F.col("user_id") < max_user)
    return kept, lines.join(kept.select("order_id"), "order_id", "left_semi").select(*lines.columns)


def valid_intervals(df: DataFrame, column: str) -> DataFrame:
    """Numeric gaps strictly between 0 and 730 days."""
    days = F.col(column).try_cast("double")
    return df.select(days.alias("days")).filter((F.col("days") > 0) & (F.col("days") < 730))
