"""Named result tables and cached results."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import shared_dir
from cartwheel.sources import folders

DATABASE = "cartwheel_views"
# Names of the dashboard tables, rows read from one, lifetime of a cached result.
VIEW_NAMES = ("product_affinity_view", "customer_journey_view", "lifetime_value_view", "churn_analysis_view")
TTL_SECONDS = 6 * 3600
AVAILABLE, NOT_FOUND = "Available", "Not Found"


def qualified(spark: SparkSession, name: str) -> str:
    """Name within the database of result tables, which is created below the shared folder."""
    if not spark.catalog.databaseExists(DATABASE):
        app = spark.sparkContext.applicationId
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE} LOCATION '{shared_dir(spark)}/cartwheel/{app}/views'")
    return f"{DATABASE}.{name}"


def _version(spark: SparkSession, name: str) -> str:
    """A new folder for a version of the table."""
    root = spark.sql(f"DESCRIBE DATABASE {DATABASE}").where("info_name = 'Location'").first()["info_value"]
    return f"{root}/{name}/version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]


def materialize(name: str, df: DataFrame, refresh: bool = False) -> DataFrame:
    """Create the table if it is missing, or anew when asked.

    Every version is written in full to a folder of its own; then one step in the catalog points the table to it. Until
    then readers have the version before, also when writing fails. The last version is kept for readers that still
    use it, older ones are removed. A version with other columns needs the table to be made anew behind the write.
    """
    spark = df.sparkSession
    table = qualified(spark, name)
    there = spark.catalog.tableExists(table)
    if there and not refresh:
        return spark.table(table)
    folder = _version(spark, name)
    df.write.parquet(folder)
    if not there:
        spark.catalog.createTable(table, path=folder, source="parquet", schema=df.schema)
        return spark.table(table)
    shape = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    last = _location(spark, table)
    if [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields] == shape:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"DROP TABLE {table}")
        spark.catalog.createTable(table, path=folder, source="parquet", schema=df.schema)
    for old in folders.children(spark, folder.rsplit("/", 1)[0]):
        if old.rsplit("/", 1)[1] not in (folder.rsplit("/", 1)[1], last.rstrip("/").rsplit("/", 1)[1]):
            folders.remove(spark, old)
    return spark.table(table)


def query_view(spark: SparkSession, name: str, where: str | None = None, max_rows: int | None = None) -> DataFrame:
    """All rows that match; the first ``max_rows`` by all columns in order if that is given."""
    df = spark.table(qualified(spark, name))
    kept = df.filter(where) if where else df
    return kept if max_rows is None else kept.orderBy(*kept.columns).limit(max_rows)


def drop_view(spark: SparkSession, name: str) -> None:
    """Drop the table with all of its versions."""
    table = qualified(spark, name)
    if spark.catalog.tableExists(table):
        folder = _location(spark, table).rstrip("/").rsplit("/", 1)[0]
        spark.sql(f"DROP TABLE {table}")
        folders.remove(spark, folder)


def view_status(spark: SparkSession, names: tuple[str, ...] = VIEW_NAMES) -> DataFrame:
    rows = [(n, AVAILABLE if spark.catalog.tableExists(qualified(spark, n)) else NOT_FOUND) for n in names]
    return spark.createDataFrame(rows, "view_name string, status string")


def refresh_all(builders: Mapping[str, Callable[[], DataFrame]]) -> dict[str, bool]:
    """Rebuild every table; tells which succeeded."""
    done = {}
    for name, build in builders.items():
        try:
            materialize(name, build(), refresh=True)
            done[name] = True
        except Exception:  # noqa: BLE001 - the others are refreshed all the same
            done[name] = False
    return done


def _cache_path(df: DataFrame, name: str, params: Mapping | None, root: str | None) -> str:
    spark = df.sparkSession
    text = f"{name}|{sorted((params or {}).items())}|{df.semanticHash()}|{folders.fingerprint(df)}"
    folder = root or f"{shared_dir(spark)}/cartwheel/{spark.sparkContext.applicationId}/cache"
    return f"{folder}/{name}-{hashlib.md5(text.encode()).hexdigest()}"


def cached_query(
    name: str, df: DataFrame, ttl: float = TTL_SECONDS, params: Mapping | None = None, root: str | None = None
) -> DataFrame:
    """The stored result of the same plan, parameters and input files when it is fresh enough, else run and store it.

    Files are known by path, size and time: a result of input that was changed, added to or removed doesn't answer.
    Every run is its own ``created_at`` folder; the newest fresh one answers. Empty results are not reused.
    """
    spark = df.sparkSession
    path = _cache_path(df, name, params, root)
    try:
        stored = spark.read.parquet(path)
        newest = stored.agg(F.max(F.col("created_at").cast("long")).alias("t")).first()["t"]
        if newest is not None and newest >= time.time() - ttl:
            return stored.filter(F.col("created_at") == newest).drop("created_at")
    except AnalysisException:
        pass  # nothing stored yet
    now = int(time.time())
    df.write.mode("overwrite").parquet(f"{path}/created_at={now}")
    return spark.read.schema(df.schema).parquet(f"{path}/created_at={now}")
