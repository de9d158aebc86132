from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartwheel.operators import joins, quality
from cartwheel.operators.quality import Rule


def test_drop_duplicates_keeps_smallest_row_and_null_key(spark):
    df = spark.createDataFrame(
        [(1, "b", 2), (1, "a", 9), (2, None, 1), (2, "a", 0), (None, "z", 1), (None, "y", 1)], "id int, name string, n int"
    )
    out = rows(quality.drop_duplicates(df, ["id"]).select("id", "name", "n"), "id")
    assert out == [(None, "y", 1), (1, "a", 9), (2, None, 1)]


def test_drop_duplicates_without_other_columns(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert rows(quality.drop_duplicates(df, ["id"]), "id") == [(1,), (2,)]


@pytest.mark.parametrize(("bad", "kept"), [(49, 951), (50, 1000), (51, 1000)])
def test_prune_only_below_five_percent(spark, bad, kept):
    df = spark.range(1000).withColumn("name", F.when(F.col("id") < bad, "").otherwise("x"))
    out, report = quality.prune_if_rare(df, [Rule("blank", quality.is_blank("name"))])
    assert out.count() == kept
    assert [r.asDict() for r in report.collect()] == [{"rule": "blank", "total": 1000, "bad": bad, "dropped": bad < 50}]


def test_prune_takes_shares_of_what_earlier_rules_left(spark):
    # 40 of 1000 rows fail the first rule; 48 of the remaining 960 (exactly 5 %) fail the second.
    df = spark.range(1000).select(
        "id", (F.col("id") < 40).alias("first"), ((F.col("id") >= 40) & (F.col("id") < 88)).alias("second")
    )
    out, report = quality.prune_if_rare(df, [Rule("first", F.col("first")), Rule("second", F.col("second"))])
    report = report.collect()
    assert [r["dropped"] for r in report] == [True, False]
    assert report[1]["total"] == 960
    assert out.count() == 960


@pytest.mark.parametrize("seed", range(4))
def test_stored_pruning_decides_like_the_lazy_one(spark, seed):
    def chance(n, per_mille):
        return F.abs(F.xxhash64("id", F.lit(seed), F.lit(n))) % 1000 < per_mille

    df = spark.range(3000).select("id", chance(1, 45).alias("a"), chance(2, 51).alias("b"), chance(3, 48).alias("c"), F.lit("x").alias("_outcome"))
    rules = [Rule("a", F.col("a")), Rule("b", F.col("b"), keep=~F.col("b") & ~chance(4, 20)), Rule("c", F.col("c"), keep=~chance(5, 60)), Rule("all", F.col("id") >= 0)]
    for frame in (df, df.limit(0)):
        (kept, report), (want, wanted) = quality.prune_once(frame, rules), quality.prune_if_rare(frame, rules)
        assert kept.columns == df.columns and rows(kept, "id") == rows(want, "id")
        assert rows(report, "rule") == rows(wanted, "rule")


def test_stored_pruning_plans_its_input_once(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "id int, k int").groupBy("k").agg(F.max("id").alias("id"))
    kept, _ = quality.prune_once(df, [Rule("blank", F.col("id") < 0)])
    assert "Aggregate" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_empty_tables_stay_empty(spark):
    empty = spark.createDataFrame([], "aisle_id int, aisle string")
    assert quality.clean_aisles(empty).count() == 0
    assert rows(quality.duplicate_report(empty, "aisle_id")) == [(0, 0)]
    report = quality.quality_report(empty, [Rule("blank", quality.is_blank("aisle"))])
    assert rows(report) == [(1, "blank", 0, 0, 0)]


def test_null_foreign_key_goes_only_when_the_rule_applies(spark):
    parent = spark.createDataFrame([(1,)], "aisle_id int")
    rare = spark.createDataFrame([(i, 1) for i in range(98)] + [(98, 7), (99, None)], "product_id int, aisle_id int")
    out, report = joins.fk_filter_small(rare, parent, "aisle_id")
    assert (out.count(), *report.select("bad", "dropped").first()) == (98, 1, True)
    common = spark.createDataFrame([(i, 1) for i in range(90)] + [(90 + i, 7) for i in range(9)] + [(99, None)], rare.schema)
    out, report = joins.fk_filter_small(common, parent, "aisle_id")
    assert (out.count(), *report.select("bad", "dropped").first()) == (100, 9, False)


def test_large_foreign_key_filter_drops_null_keys(spark):
    child = spark.createDataFrame([(1, 1), (2, 1), (None, 1)], "order_id int, product_id int")
    parent = spark.createDataFrame([(1,), (1,), (3,)], "order_id int")
    assert rows(joins.fk_filter_large(child, parent, "order_id")) == [(1, 1)]


def test_checks_are_never_null(spark):
    df = spark.createDataFrame([("5",), ("x",), ("",), (None,), ("31",)], "v string")
    out = df.select(
        "v",
        quality.not_int("v").alias("i"),
        quality.is_blank("v").alias("b"),
        quality.outside_domain("v", ["5"]).alias("d"),
        quality.outside_range("v", 0, 30).alias("r"),
        quality.outside_range("v", 0, 30, nullable=True).alias("n"),
    )
    got = {r["v"]: tuple(r)[1:] for r in out.collect()}
    assert got["5"] == (False, False, False, False, False)
    assert got["x"] == (True, False, True, True, True)
    assert got[""] == (True, True, True, True, True)
    assert got[None] == (True, True, True, True, False)
    assert got["31"] == (False, False, True, True, True)


def test_normalize_and_blank(spark):
    df = spark.createDataFrame([(1, " Na ", None), (2, "nab", "x")], "id int, a string, days_since_prior string")
    assert rows(quality.normalize_na(df), "id") == [("1", "", ""), ("2", "nab", "x")]
    blank = spark.createDataFrame([("", "")], "days_since_prior string, a string")
    assert rows(quality.blank_to_null(blank)) == [(None, "")]


def test_shape_order(spark):
    df = spark.createDataFrame(
        [(1, 2, 3, 4, 5, None), (2, 2, 3, 4, 5, 31), (3, 2, 3, 4, 5, -4)],
        "order_id int, user_id int, order_number int, order_dow int, order_hour_of_day int, days_since_prior int",
    )
    out = quality.shape_order(df)
    assert tuple(out.columns) == quality.ORDER_RECORD
    assert [r["days_since_prior"] for r in out.orderBy("order_id").collect()] == [0, 30, -4]


def test_numbers_or_text(spark):
    df = spark.createDataFrame([("1", "1.5", "a"), ("2.0", None, "3")], "whole string, part string, text string")
    out = quality.numeric_or_text(df, ["whole", "part", "text"])
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "double", "string"]
    assert rows(quality.coerce_int(df, ["text"]).select("text"), "text") == [(0,), (3,)]


def test_pairs_count_repeated_products_like_a_join_of_lines(spark):
    lines = spark.createDataFrame([(1, 10), (1, 10), (1, 20), (2, 10), (2, 20), (2, 30)], "order_id int, product_id int")
    out = rows(joins.basket_pairs(lines), "product1_id", "product2_id")
    assert out == [(10, 20, 3), (10, 30, 1), (20, 30, 1)]


def test_top_products_breaks_ties_by_id(spark):
    lines = spark.createDataFrame([(3,), (1,), (2,), (2,)], "product_id int")
    assert rows(joins.top_products(lines, 2)) == [(2, 2), (1, 1)]


def test_rare_rule_plans_without_a_job(spark):
    df = spark.range(100).withColumn("name", F.lit("x"))
    spark.sparkContext.setJobGroup("rare-plan", "")
    out, report = quality.prune_if_rare(df, [Rule("blank", quality.is_blank("name"))])
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("rare-plan")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert (out.count(), report.count()) == (100, 1)
