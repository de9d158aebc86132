"""File readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.schemas import LANDING_PARTITIONS, PARTITION_KEYS
from cartwheel.session import ship_package
from cartwheel.sources import folders

STAMP_FORMAT = "yyyy-MM-dd-HHmm"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV files with a header anywhere below ``path``."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).option("header", True).csv(path)


def read_catalog_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Raw catalog files: header, comma, the text NA for a missing value."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "NA").csv(path)


def read_csv_gz(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Gzipped or plain CSV with a header; the file ending decides. A gzip file is read by one task, so keep them small."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str, recursive: bool = False, skip_bad: bool = False) -> DataFrame:
    """Parquet folder; optionally with all folders below it and without unreadable files (``skipped_files`` lists them).

    No readable file is an error. Where bad files are skipped, the columns come from the footers of all files, since
    any single one may be a bad one.
    """
    reader = spark.read.option("recursiveFileLookup", recursive).option("ignoreCorruptFiles", skip_bad)
    if skip_bad:
        reader = reader.option("mergeSchema", True)
    if recursive:
        reader = reader.option("pathGlobFilter", "*.parquet")
    return reader.parquet(path)


def skipped_files(spark: SparkSession, path: str) -> DataFrame:
    """path and reason of every file below ``path`` that ``read_parquet`` with ``skip_bad`` leaves out.

    Files that gave a row are done with. Of the others the last bytes decide: ``no parquet footer`` or
    ``unreadable footer``; a file whose footer says that it holds no rows is not skipped. A file that breaks before its
    footer is ``unreadable data``. Files of no bytes are never opened by Spark's readers and don't count as skipped. If
    no file at all could be read, that is an error.
    """
    ship_package(spark)
    pattern = "*.parquet"
    listed = folders.listing(spark, [path], pattern)
    known = read_parquet(spark, path, recursive=True, skip_bad=True)
    # Counting each column reads the data behind the footers too; only the number of rows decides.
    values = [F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(known.columns)]
    read = known.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"), *values)
    seen = F.greatest("rows", *[f"_{i}" for i in range(len(values))])
    read = read.select(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("path"), seen.alias("rows"))
    plain = F.regexp_replace("path", "^file:/+", "file:/")
    left = listed.withColumn("path", plain).join(read.withColumn("path", plain), "path", "left")
    bodies = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
        .select(plain.alias("path"), "length", F.substring("content", -FOOTER_BYTES, FOOTER_BYTES).alias("tail"))
    )
    checked = bodies.mapInArrow(_footers, "path string, footer string, footer_rows long")
    reason = (
        F.when(F.coalesce("footer", F.lit("unreadable footer")) != "good", F.coalesce("footer", F.lit("unreadable footer")))
        .when(F.coalesce("rows", F.lit(0)) < F.coalesce("footer_rows", F.lit(0)), "unreadable data")
    )
    return left.join(checked, "path", "left").select("path", reason.alias("reason")).where("reason is not null")


#: Bytes at the end of a file in which its footer is looked for; a larger footer is read with the whole file.
FOOTER_BYTES = 1 << 20


def _footers(batches):
    """What the last bytes of each file say of it."""
    import io

    import pyarrow as pa
    import pyarrow.parquet as pq

    for batch in batches:
        found = []
        for length, tail in zip(batch.column("length").to_pylist(), batch.column("tail").to_pylist()):
            if len(tail) < 12 or tail[-4:] != b"PAR1":
                found.append(("no parquet footer", None))
            else:
                size = int.from_bytes(tail[-8:-4], "little") + 8
                if size > min(len(tail), length):
                    found.append(("unreadable footer", None) if size > length else ("good", None))
                    continue
                try:
                    # A footer is read on its own when four bytes of a beginning stand before it.
                    found.append(("good", pq.read_metadata(io.BytesIO(b"PAR1" + tail[-size:])).num_rows))
                except Exception:  # noqa: BLE001 - whatever is wrong with it
                    found.append(("unreadable footer", None))
        columns = list(zip(*found)) if found else [[], []]
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64())],
            names=["path", "footer", "footer_rows"],
        )


def stamp() -> Column:
    """Time of a landing partition; NULL where the keys do not form one."""
    return F.try_to_timestamp(F.concat_ws("-", *PARTITION_KEYS), F.lit(STAMP_FORMAT))


def landing_keys(path: Column | str) -> dict[str, Column]:
    """Partition keys (year, month, day, hhmm) of a landed file as text columns, empty where its folders lack one.

    Given a path, they are literals for all rows of that file; given a column such as ``_metadata.file_path``, each
    row has those of its own file, so that many files are read in one scan.
    """
    path = F.lit(path) if isinstance(path, str) else path
    return {key: F.regexp_extract(path, f"/{key}=([^/]*)/", 1) for key in PARTITION_KEYS}


def read_landing(
    spark: SparkSession, path: str, schema: str, start_ts: str | None = None, end_ts: str | None = None
) -> DataFrame:
    """Landed CSV partitions stamped within the inclusive range; partitions without a valid stamp are kept.

    The filter uses partition columns only, so other folders are never opened.
    """
    reader = spark.read.schema(f"{schema}, {LANDING_PARTITIONS}").option("header", True)
    df = reader.option("basePath", path).csv(path)
    for bound, inside in ((start_ts, lambda t, b: t >= b), (end_ts, lambda t, b: t <= b)):
        if bound is not None:
            limit = F.try_to_timestamp(F.lit(bound), F.lit(STAMP_FORMAT))
            # An unreadable bound does not restrict.
            df = df.filter(stamp().isNull() | limit.isNull() | inside(stamp(), limit))
    return df


def table_of_file(path: Column) -> Column:
    """``orders`` from ``.../orders_part3.csv`` or ``.../orders.csv.gz``, also where that is a folder of ``part-`` files."""
    steps = F.split(path, "/")
    last = F.element_at(steps, -1)
    name = F.when(last.startswith("part-"), F.element_at(steps, -2)).otherwise(last)
    return F.element_at(F.split(F.element_at(F.split(name, "_part"), 1), r"\."), 1)


def table_of_prefix(prefix: str) -> str:
    return prefix.rstrip("/").rsplit("/", 1)[-1]


def tables_from_files(spark: SparkSession, path: str, allow: Sequence[str] | None = None) -> DataFrame:
    """Lines of all CSV and gzip files below ``path`` with their table name; other files are left alone."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{csv,gz}").text(path)
    named = lines.select(table_of_file(F.col("_metadata.file_path")).alias("table_name"), F.col("value").alias("line"))
    return named if not allow else named.filter(F.col("table_name").isin(list(allow)))


def bulk_load_csv(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """Replace ``table`` by the CSV files at ``path``: one header row, optional double quotes, short or long rows allowed."""
    loaded = (
        spark.read.schema(schema).option("header", True).option("quote", '"').option("mode", "PERMISSIVE")
        .option("enforceSchema", True).csv(path)
    )
    loaded.write.mode("overwrite").saveAsTable(table)
    return spark.table(table)


SIDE = "struct<precision:double,recall:double,map:double,ndcg:double>"
METRICS_SCHEMA = f"top_k int, finished_at_utc string, users_evaluated long, als {SIDE}, baseline {SIDE}, lift {SIDE}"
COVERAGE_SCHEMA = "coverage_item double, coverage_user_eval double"


def _run_documents(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """Documents ``<run>/<name>`` below ``root``, each a file or a folder of files, with run folder and file time."""
    path = F.col("_metadata.file_path")
    prefix = F.regexp_extract(path, f"^(.*)/{name.replace('.', '[.]')}(/[^/]*)?$", 1)
    df = spark.read.schema(schema).option("multiLine", True).json(f"{root}/*/{name}")
    return df.select("*", prefix.alias("run_prefix"), F.col("_metadata.file_modification_time").alias("file_time"))


def read_run_metrics(spark: SparkSession, root: str) -> DataFrame:
    """One row per run folder with a ``metrics.json``, with its ``coverage.json`` where there is one."""
    metrics = _run_documents(spark, root, "metrics.json", METRICS_SCHEMA)
    try:
        coverage = _run_documents(spark, root, "coverage.json", COVERAGE_SCHEMA).drop("file_time")
    except AnalysisException:  # no run has one
        coverage = spark.createDataFrame([], f"{COVERAGE_SCHEMA}, run_prefix string")
    joined = metrics.join(coverage, "run_prefix", "left")
    return joined.withColumn("run_id", F.element_at(F.split("run_prefix", "/"), -1))
