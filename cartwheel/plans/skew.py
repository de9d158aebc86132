"""Numbering that survives a key holding a large share of all rows.

A window over a key sorts the whole group in one task. The helpers below sort by range partitions, which cut any group
into pieces of bounded size, number each piece on its own and add the rows of the pieces before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.session import scratch, shared_dir

#: Keys are counted in buckets by hash; those of a bucket with more rows than this are cut into ranges.
BUCKETS, LIGHT_ROWS = 65_536, 500_000


def number_by_size(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lag: str | None = None,
    fold: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    most: int = LIGHT_ROWS,
) -> DataFrame:
    """As ``number_in_group`` of ``fold(df)``, where most keys have few rows: those are shuffled once, by ``keys``.

    ``fold`` may aggregate rows by ``keys`` and further columns. Only keys in a bucket of more than ``most`` rows,
    before folding, take the way over ranges and written pieces.
    """
    keys, order, bucket = list(keys), list(order), F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    # At most BUCKETS numbers.
    counted = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > most)
    heavy = [r["bucket"] for r in counted.collect()]
    if len(heavy) > BUCKETS // 64:
        return number_in_group(fold(df), keys, order, lag)
    light = fold((df.where(~bucket.isin(heavy)) if heavy else df).repartition(*[F.col(k) for k in keys]))
    group = Window.partitionBy(*keys)
    added = {"rn": F.row_number().over(group.orderBy(*order)), "group_rows": F.count(F.lit(1)).over(group)}
    numbered = light.withColumns({**added, "prev": F.lag(lag).over(group.orderBy(*order))} if lag else added)
    if not heavy:
        return numbered
    return numbered.unionByName(number_in_group(fold(df.where(bucket.isin(heavy))), keys, order, lag))


def number_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], lag: str | None = None) -> DataFrame:
    """Add ``rn`` (1..n within ``keys`` by ``order``), ``group_rows`` (n) and, if asked, ``prev`` (lag of a column).

    Rows are partitioned by ranges of keys and order, with a hash last that deals out rows equal in both, and written
    once so that the ranges stay. Only keys that lie in several partitions need an offset; a range partition has at
    most two of them, so the offsets have at most two rows per partition.
    """
    keys, order, spark = list(keys), list(order), df.sparkSession
    tie = F.xxhash64(F.monotonically_increasing_id())
    ranged = (
        df.withColumn("_tie", tie).repartitionByRange(*keys, *order, "_tie").withColumn("_part", F.spark_partition_id())
    )
    path = scratch(spark, "numbered")
    ranged.write.parquet(path)
    placed = spark.read.schema(ranged.schema).parquet(path)
    piece = Window.partitionBy("_part", *keys)
    ordered = piece.orderBy(*order, "_tie")
    added = {"_rn": F.row_number().over(ordered), "_rows": F.count(F.lit(1)).over(piece)}
    numbered = placed.withColumns({**added, "_lag": F.lag(lag).over(ordered)} if lag else added)

    last = F.max_by(F.col(lag), F.struct(*order, "_tie")) if lag else F.lit(None).cast("int")
    pieces = placed.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_rows"), last.alias("_last"))
    wide = pieces.groupBy(*keys).agg(F.count(F.lit(1)).alias("_pieces")).where("_pieces > 1")
    by_piece = Window.partitionBy(*keys).orderBy("_part")
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"w.{k}")) for k in keys]
    offsets = (
        pieces.alias("p")
        .join(wide.alias("w"), same, "left_semi")
        .select(
            F.col("_part").alias("_o_part"),
            *[F.col(k).alias(f"_o_{k}") for k in keys],
            F.sum("_rows").over(by_piece.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
            F.sum("_rows").over(Window.partitionBy(*keys)).alias("_total"),
            F.lag("_last").over(by_piece).alias("_prev_last"),
        )
    )
    found = [numbered["_part"] == offsets["_o_part"], *[numbered[k].eqNullSafe(offsets[f"_o_{k}"]) for k in keys]]
    out = numbered.join(offsets, found, "left")
    columns = [
        *[numbered[c] for c in df.columns],
        (F.col("_rn") + F.coalesce("_before", F.lit(0))).alias("rn"),
        F.coalesce("_total", "_rows").alias("group_rows"),
    ]
    if lag:
        columns.append(F.coalesce("_lag", "_prev_last").alias("prev"))
    return out.select(*columns)


def global_running_count(df: DataFrame, order: Sequence[str | Column], flag: Column, name: str) -> DataFrame:
    """For each row the number of flagged rows up to and including it in the global ``order``.

    The running sum stays within a range partition, fixed by a checkpoint; the sums of the partitions before, one row
    per partition, are added.
    """
    shared_dir(df.sparkSession)
    placed = (
        df.withColumn("_flag", F.when(flag, 1).otherwise(0))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_id", 33))
    )
    sums = placed.groupBy("_part").agg(F.sum("_flag").alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    running = F.sum("_flag").over(Window.partitionBy("_part").orderBy("_id"))
    return (
        placed.withColumn("_run", running)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_before") + F.col("_run")).alias(name))
    )
