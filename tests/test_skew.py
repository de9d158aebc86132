"""Numbering must not depend on how groups fall into partitions."""

from __future__ import annotations

from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.plans import skew
from cartwheel.plans.star import derive_lines, derive_orders


def skewed(spark):
    # User 0 holds a third of all rows.
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("user"), (F.col("id") * 7919 % 997).alias("day")
    )


def test_number_in_group_over_many_partitions(spark):
    df = skewed(spark)
    w = Window.partitionBy("user").orderBy("day", "id")
    want = df.select(
        "id", "user", F.row_number().over(w).alias("rn"), F.count(F.lit(1)).over(Window.partitionBy("user")).alias("group_rows"),
        F.lag("day").over(w).alias("prev"),
    )
    for partitions in ("1", "7", "40"):
        kept = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = skew.number_in_group(df, ["user"], ["day", "id"], lag="day")
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        assert rows(got.select(*want.columns), "id") == rows(want, "id")


def test_equal_rows_and_null_keys_are_numbered_too(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 > 0, 1).alias("user"), F.lit("a").alias("day"))
    got = rows(skew.number_in_group(df, ["user"], ["day"]).groupBy("user").agg(F.min("rn"), F.max("rn"), F.countDistinct("rn"), F.max("group_rows")), "user")
    assert got == [(None, 1, 300, 300, 300), (1, 1, 600, 600, 600)]


def test_heavy_order_with_large_line_numbers(spark):
    lines = spark.range(2000).select(
        F.when(F.col("id") < 1500, 1).otherwise(F.col("id")).alias("l_orderkey"), (F.col("id") * 3).alias("l_partkey"),
        (F.col("id") + (1 << 23)).alias("l_linenumber"),
    )
    orders = lines.select(F.col("l_orderkey").alias("order_id"), F.lit(5).alias("user_id"), F.lit(1).alias("order_number"), F.lit("prior").alias("eval_set")).distinct()
    got = rows(derive_lines(lines, orders).where("order_id = 1").select("add_to_cart_order", "product_id"), "add_to_cart_order")
    assert got == [(i + 1, i * 3) for i in range(1500)]


def test_user_with_all_orders_on_one_date(spark):
    orders = spark.range(3000).select(
        F.col("id").alias("o_orderkey"), F.lit(7).alias("o_custkey"), F.lit("2020-01-01").alias("o_orderdate")
    )
    got = rows(derive_orders(orders).select("order_id", "order_number", "eval_set"), "order_id")
    assert [r[1] for r in got] == list(range(1, 3001)) and got[-1][2] == "test" and {r[2] for r in got[:-1]} == {"prior"}


def test_global_running_count(spark):
    flag = F.col("user") == 0
    got = rows(skew.global_running_count(skewed(spark), ["day", "id"], flag, "n").select("day", "id", "user", "n"), "day", "id")
    total = 0
    for day, row_id, user, n in got:
        total += user == 0
        assert n == total, (day, row_id)


def test_numbering_by_size_takes_one_shuffle_and_agrees_with_ranges(spark):
    df = skewed(spark).select("user", "day", "id")
    light = skew.number_by_size(df, ["user"], ["day", "id"], lag="day")
    assert light._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    names, by = ["user", "day", "id", "rn", "group_rows", "prev"], ("user", "day", "id")
    want = rows(skew.number_in_group(df, ["user"], ["day", "id"], lag="day").select(*names), *by)
    assert rows(light.select(*names), *by) == want
    # Some keys are in heavy buckets.
    both = skew.number_by_size(df, ["user"], ["day", "id"], lag="day", most=100)
    assert rows(both.select(*names), *by) == want


def test_reordered_of_repeated_and_unknown_keys(spark):
    lines = spark.createDataFrame([(1, 5, 1), (2, 5, 1), (2, 5, 2), (3, None, 1), (4, 5, 1), (1, 6, 2)], "l_orderkey long, l_partkey long, l_linenumber int")
    orders = spark.createDataFrame(
        [(1, 9, 1, "prior"), (2, 9, 2, "prior"), (3, 9, 3, "train"), (4, None, 1, "prior")], "order_id long, user_id long, order_number int, eval_set string"
    )
    got = rows(derive_lines(lines, orders), "order_id", "product_id")
    assert got == [(1, 5, 1, 0, "prior"), (1, 6, 2, 0, "prior"), (2, 5, 1, 1, "prior")]


def test_star_queries_have_small_tasks(spark, sf_dir):
    from cartwheel.plans.star import load_star

    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        for given, left in (("128MB", 32 << 20), ("134217728b", 32 << 20), ("1g", 32 << 20), ("8m", "8m"), ("1048576", "1048576")):
            for name in names:
                spark.conf.set(name, given)
            load_star(spark, sf_dir)
            assert [spark.conf.get(n) for n in names] == [str(left)] * 2
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
