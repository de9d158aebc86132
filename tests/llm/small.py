from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("kept", StringType()),
        StructField("row", LongType()),
    ]
)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Small documents with extra columns whose names clash with the operators' own."""

    def make(pairs, parts=3):
        rows = [(i, t, "x", None) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS).coalesce(1).repartition(parts) if rows else spark.createDataFrame([], DOCS)

    return make


@pytest.fixture(scope="session")
def stored(spark, docs_of, tmp_path_factory):
    """The same, written as Parquet in several files."""

    def make(pairs, parts=3):
        path = str(tmp_path_factory.mktemp("docs") / "t")
        docs_of(pairs, parts).write.parquet(path)
        return spark.read.schema(DOCS).parquet(path)

    return make

@pytest.fixture
def other_splits(spark):
    """From its call on, file scans deal their files to tasks in another way, as with other executors."""

    def change():
        spark.conf.set("spark.sql.files.minPartitionNum", "1")

    yield change
    spark.conf.unset("spark.sql.files.minPartitionNum")
