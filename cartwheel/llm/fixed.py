"""Small tables given in the code, as DataFrames of literals."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A frame of the given rows, built from one JSON literal inside the JVM."""
    parsed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(parsed))
