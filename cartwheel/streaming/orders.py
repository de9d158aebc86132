"""Order records arriving as a stream: decode, parse, shape, split failures, write by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.operators.quality import ORDER_RECORD, STREAM_EVAL_SET, shape_order
from cartwheel.schemas import PARTITION_KEYS

# Envelope and record layout, outcome names.
ENVELOPE = "recordId string, data string"
RECORD = ", ".join(f"{c} variant" for c in ORDER_RECORD if c != "eval_set") + ", _broken string"
OK, FAILED = "Ok", "ProcessingFailed"
DECODE_ERROR, PARSE_ERROR = "decode-failed", "processing-failed"
TIME_FORMATS = {"year": "yyyy", "month": "MM", "day": "dd", "hhmm": "HHmm"}


def read_order_stream(spark: SparkSession, path: str, schema: str = ENVELOPE, files_per_trigger: int = 1000) -> DataFrame:
    """Stream of envelope records from JSON-line files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def parse(df: DataFrame) -> DataFrame:
    """Add ``payload`` (decoded text) and ``record`` (its fields as they came); either is NULL when its step fails.

    Bytes that aren't UTF-8 are a failed decoding, not a failed query.
    """
    payload = F.try_validate_utf8(F.expr("try_to_binary(data, 'base64')").cast("string"))
    parsed = df.withColumn("payload", payload).withColumn(
        "_parsed", F.from_json("payload", RECORD, {"columnNameOfCorruptRecord": "_broken"})
    )
    whole = F.col("_parsed._broken").isNull() & F.trim("payload").startswith("{")
    return parsed.withColumn("record", F.when(whole, F.col("_parsed"))).drop("_parsed")


def _as_came(name: str) -> Column:
    """The JSON text of a field as it came; NULL for a missing field or a null."""
    return F.nullif(F.to_json(F.col(f"record.{name}")), F.lit("null"))


def _typed(name: str, kind: str) -> Column:
    """The field as a number of the kind, also from a text; NULL where it is none."""
    return F.try_variant_get(f"record.{name}", "$", "double").try_cast(kind)


def transform_order_stream(df: DataFrame) -> DataFrame:
    """Envelope records to (recordId, result, data, error_type and the shaped fields), for streams and tables alike.

    Good records carry the shaped line, encoded again; failed ones their payload as it came. Fields pass into the line
    as they came, whatever their type; only the gap must be a number, or be missing. The shaped columns hold the
    fields that are whole numbers, or texts of whole numbers.
    """
    gap, days = _as_came("days_since_prior"), _typed("days_since_prior", "double")
    no_number = F.substring(gap, 1, 1).isin('"', "[", "{")
    line_days = F.when(gap.isNull(), "0").when(days > 30, "30").otherwise(gap)
    parts = []
    for i, name in enumerate(ORDER_RECORD):
        value = F.lit(f'"{STREAM_EVAL_SET}"') if name == "eval_set" else line_days if name == "days_since_prior" else _as_came(name)
        parts += [F.lit(f'{", " if i else "{"}"{name}": '), F.coalesce(value, F.lit("null"))]
    # Base64 output of long lines is wrapped; a record is one piece.
    encoded = F.regexp_replace(F.base64(F.encode(F.concat(*parts, F.lit("}\n")), "utf-8")), r"\s", "")
    parsed = parse(df)
    error = (
        F.when(F.col("payload").isNull(), DECODE_ERROR)
        .when(F.col("record").isNull() | F.coalesce(no_number, F.lit(False)), PARSE_ERROR)
    )
    fields = [c for c in ORDER_RECORD if c != "eval_set"]
    flat = parsed.withColumn("error_type", error).select(
        "recordId",
        F.when(F.col("error_type").isNull(), OK).otherwise(FAILED).alias("result"),
        F.when(F.col("error_type").isNull(), encoded).otherwise(F.col("data")).alias("data"),
        "error_type",
        *[_typed(c, "long" if c.endswith("_id") else "int").alias(c) for c in fields],
    )
    return shape_order(flat)


def split_failures(transformed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shaped good records, and failed ones with the original payload."""
    good = transformed.filter(F.col("result") == OK).select("recordId", *ORDER_RECORD)
    failed = transformed.filter(F.col("result") == FAILED).select("recordId", "data", "error_type")
    return good, failed


def stream_sink(
    transformed: DataFrame, path: str, errors_path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Write good records by arrival time and failed ones by error type as well.

    A batch writes below its own ``batch=<id>`` folder and overwrites it, so a batch that is run again after a failure
    leaves no duplicates.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        now = F.current_timestamp()
        timed = batch.withColumns({k: F.date_format(now, TIME_FORMATS[k]) for k in PARTITION_KEYS})
        kept = timed.persist()
        try:
            good = kept.filter(F.col("result") == OK).select("recordId", *ORDER_RECORD, *PARTITION_KEYS)
            failed = kept.filter(F.col("result") == FAILED).select("recordId", "data", "error_type", *PARTITION_KEYS)
            good.write.mode("overwrite").partitionBy(*PARTITION_KEYS).parquet(f"{path}/batch={batch_id}")
            failed.write.mode("overwrite").partitionBy("error_type", *PARTITION_KEYS).json(
                f"{errors_path}/batch={batch_id}"
            )
        finally:
            kept.unpersist()

    writer = transformed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
