"""Shared pieces of the text operators: input columns, bounded Arrow slices, written tables, membership bitmaps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import scratch, ship_package

SLICE_BYTES = 4 << 20
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text`` alone; a null text is the empty text, other columns are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def whole_text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def row_key() -> Column:
    """128 bits, as binary, that stand for (doc_id, text); only rows equal in both share them."""
    number = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    return F.unhex(F.md5(F.concat(number, F.lit(":"), whole_text())))


def unused(df: DataFrame, name: str) -> str:
    """``name``, or the like, that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def python_ready(spark: SparkSession) -> None:
    """Make the package importable in Python workers and keep Arrow batches of long texts small."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 1000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def slices(batches, column: str = "text", most: int = SLICE_BYTES):
    """Cut record batches so that each piece holds at most ``most`` bytes of ``column``, or a single row."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(sizes):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back; cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str, column: str = "__row") -> DataFrame:
    """``docs`` written once with a number for each row in ``column``, larger for later rows.

    Rows that are read twice and joined on a number need this: how a scan deals files to tasks follows the executors
    that are registered at that moment, and with it what monotonically_increasing_id() gives to a row.
    """
    return written(docs.withColumn(column, F.monotonically_increasing_id()), name, compression="zstd")


def bitmap(keys: DataFrame, bits: int | None = None) -> np.ndarray:
    """Words of a bitmap with two places for each value of the long column ``key``, at most ``MOST_BITS`` bits (16 MB).

    Its size follows the number of keys up to that bound. Beyond it more keys that were never put in seem to be there;
    users of the bitmap must decide exactly afterwards, so only their volume changes, not their result.
    """
    if bits is None:
        bits = min(MOST_BITS, max(LEAST_BITS, 1 << (32 * keys.count()).bit_length()))
    last = bits - 1
    words = (
        keys.select(F.explode(F.array(F.expr(f"key & {last}L"), F.expr(f"shiftrightunsigned(key, 37) & {last}L"))).alias("slot"))
        .select(F.expr("shiftright(slot, 6)").alias("word"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(bits >> 6, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def in_bitmap(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each 64-bit key may be in the bitmap."""
    keys, last = keys.view(np.uint64), np.uint64((len(words) << 6) - 1)

    def held(slot):
        return (words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1

    out = held(keys & last)
    some = np.flatnonzero(out)
    out[some] = held((keys[some] >> np.uint64(37)) & last)
    return out
