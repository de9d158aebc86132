"""Database reader and writer.

Both hand Spark's JDBC source its options; the reader splits a table on a numeric key into parallel range scans, so
rows neither repeat nor vanish between pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows per extract page and per insert batch. Connections at a time that a database is asked for at most.
PAGE_ROWS = 1_000_000
BATCH_ROWS = 10_000
MOST_PAGES = 256


def pages(rows: int, page_rows: int = PAGE_ROWS, most: int = MOST_PAGES) -> int:
    """Number of range scans for a table of ``rows`` rows, whatever its keys are."""
    return min(most, max(1, -(-rows // page_rows)))


def range_predicates(key: str, bounds: list) -> list[str]:
    """Conditions that together hold once for every row: below the first bound or without a key, between two bounds,
    from the last bound on."""
    cuts = sorted(set(bounds))
    if not cuts:
        return ["1 = 1"]
    middle = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *middle, f"{key} >= {cuts[-1]}"]


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, properties: dict | None = None, page_rows: int = PAGE_ROWS
) -> DataFrame:
    """A whole table, read in parallel ranges of the numeric ``key`` that hold about as many rows each."""
    options = properties or {}
    keys = spark.read.jdbc(url, table, properties=options).select(key)
    n = pages(keys.count(), page_rows)
    bounds = []
    if n > 1:
        bounds = keys.agg(F.percentile_approx(key, [i / n for i in range(1, n)])).first()[0] or []
    return spark.read.jdbc(url, table, predicates=range_predicates(key, bounds), properties=options)


def new_rows(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys the target lacks; appending only these makes a second run harmless."""
    return df.join(existing.select(*keys), keys, "left_anti").select(*df.columns)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None, batch: int = BATCH_ROWS) -> None:
    """Append all rows in batches; Spark commits each partition on its own. Running it twice appends twice; filter with ``new_rows`` first where that matters."""
    df.write.mode("append").option("batchsize", batch).jdbc(url, table, properties=properties or {})
