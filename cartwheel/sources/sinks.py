"""File writers."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.quality import normalize_na
from cartwheel.schemas import PARTITION_KEYS
from cartwheel.sources import folders

# Time zone of landing stamps, rows per landed file, stamp formats.
LANDING_ZONE = "Australia/Sydney"
PAGE_ROWS = 1_000_000
STAMP_PARTS = {"year": "%Y", "month": "%m", "day": "%d", "hhmm": "%H%M"}
RUN_FORMAT = "%Y%m%d-%H%M%S"


def _staged(df: DataFrame, path: str, columns: Iterable[str] = ()) -> int:
    """Write to a folder beside ``path``, compare the rows there with those that went in, then swap the folders."""
    spark, work = df.sparkSession, folders.beside(path, "work")
    seen = Observation()
    try:
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
        (writer.partitionBy(*columns) if columns else writer).parquet(work)
        # Counted from the files' own row counts.
        rows = spark.read.schema(df.schema).parquet(work).count()
        if rows != seen.get["rows"]:
            raise OSError(f"{rows} of {seen.get['rows']} rows arrived in {work}")
        folders.swap(spark, work, path)
    except Exception:
        folders.remove(spark, work)
        raise
    return rows


def write_parquet(df: DataFrame, path: str, coalesce: int | None = None) -> int:
    """Replace the folder, or leave it as it was when anything fails; ``df`` may read from it. Returns the rows.

    ``coalesce`` is for small results; large ones keep their partitions.
    """
    return _staged(df.coalesce(coalesce) if coalesce else df, path)


def write_partitioned(df: DataFrame, path: str, columns: Iterable[str] = ("eval_set",)) -> int:
    """As ``write_parquet``, with a folder for each value of ``columns``."""
    return _staged(df, path, tuple(columns))


def landing_stamp(run_ts: datetime, zone: str = LANDING_ZONE) -> dict[str, str]:
    """Partition values of a run; a time without a zone is taken as UTC."""
    aware = run_ts if run_ts.tzinfo else run_ts.replace(tzinfo=timezone.utc)
    local = aware.astimezone(ZoneInfo(zone))
    return {key: local.strftime(fmt) for key, fmt in STAMP_PARTS.items()}


def land_table(df: DataFrame, path: str, run_ts: datetime) -> None:
    """Write one landing partition as CSV with a header, missing values and NA as empty text.

    The run's own partition folder is replaced, so landing the same run again leaves no duplicates.
    """
    stamp = landing_stamp(run_ts)
    folder = "/".join(f"{key}={stamp[key]}" for key in PARTITION_KEYS)
    writer = normalize_na(df).write.mode("overwrite").option("maxRecordsPerFile", PAGE_ROWS)
    writer.option("header", True).option("emptyValue", "").csv(f"{path}/{folder}")


def register_landing(spark: SparkSession, table: str, path: str, schema: str) -> None:
    """Catalog table over a landing folder; a second call only refreshes its partitions."""
    if not spark.catalog.tableExists(table):
        columns = f"{schema}, year string, month string, day string, hhmm string"
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING csv OPTIONS (header true) "
            f"PARTITIONED BY ({', '.join(PARTITION_KEYS)}) LOCATION '{path}'"
        )
    spark.catalog.recoverPartitions(table)


def land_batch(spark: SparkSession, tables: dict[str, DataFrame], root: str, run_ts: datetime) -> DataFrame:
    """Land every table below ``root``; a failing table does not stop the rest. Returns one log row per table."""
    log = []
    for name, df in tables.items():
        try:
            land_table(df, f"{root}/{name.lower()}", run_ts)
            log.append((name, "SUCCESS", None))
        except Exception as error:  # noqa: BLE001 - the log row carries it
            log.append((name, "ERROR", str(error).split("\n", 1)[0]))
    return spark.createDataFrame(log, "table_name string, status string, message string").withColumn(
        "run_ts", F.lit(run_ts.isoformat())
    )


def write_run(
    root: str, run_id: str, lifted: DataFrame, top_k: int, finished_at: str | None = None, coverage: DataFrame | None = None
) -> str:
    """Write the documents of an evaluation run, ``<run_id>/metrics.json`` and ``coverage.json``; returns the run folder.

    ``lifted`` is the row of ``evaluate.metrics_lift``, ``coverage`` that of ``evaluate.coverage``. Without
    ``finished_at`` readers go by the file time. Metrics come last, since a run counts from then on; a run that is
    there already is an error.
    """
    if coverage is not None:
        coverage.withColumn("top_k", F.lit(top_k)).coalesce(1).write.json(f"{root}/{run_id}/coverage.json")
    sides = [
        F.struct(*[F.col(c).alias(c.removeprefix(f"{side}_")) for c in lifted.columns if c.startswith(f"{side}_")]).alias(name)
        for side, name in (("model", "als"), ("baseline", "baseline"), ("lift", "lift"))
    ]
    finished = [] if finished_at is None else [F.lit(finished_at).alias("finished_at_utc")]
    document = lifted.select(F.lit(top_k).alias("top_k"), *finished, "users_evaluated", *sides)
    document.coalesce(1).write.json(f"{root}/{run_id}/metrics.json")
    return f"{root}/{run_id}"


def publish(df: DataFrame, root: str, run_ts: datetime, name: str = "data") -> str:
    """Write ``run-<stamp>/`` once, then add a line to the pointer table ``latest/``. Returns the run folder.

    Readers see the run before until the line is committed; nothing is moved or written twice.
    """
    stamp = run_ts.strftime(RUN_FORMAT)
    run = f"run-{stamp}/{name}"
    df.write.mode("overwrite").parquet(f"{root}/{run}")
    line = df.sparkSession.range(1).select(F.lit(stamp).alias("stamp"), F.lit(run).alias("run"))
    line.coalesce(1).write.mode("append").json(f"{root}/latest/{name}")
    return f"{root}/{run}"


def read_latest(spark: SparkSession, root: str, name: str = "data") -> DataFrame:
    """The table of the run with the highest stamp."""
    lines = spark.read.schema("stamp string, run string").json(f"{root}/latest/{name}")
    return spark.read.parquet(f"{root}/{lines.agg(F.max_by('run', 'stamp')).first()[0]}")


def export_cohorts(records: DataFrame, path: str) -> None:
    """Nested records, one JSON line each, with missing values spelled out."""
    records.write.mode("overwrite").option("ignoreNullFields", False).json(path)
