"""Session settings and the shared work folder."""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Small tables are broadcast by measured size only; larger ones fall back to a shuffle join.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Call-site capture for error messages doubles the time to build a query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "cartwheel", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse stands in, which executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/cartwheel/{app}/{name}-{uuid.uuid4().hex[:12]}"


#: What a task of a query on the fact tables reads at most, of files and of shuffled rows.
TASK_BYTES = 32 * 1024 * 1024


def small_tasks(spark: SparkSession, most: int = TASK_BYTES) -> None:
    """Let a task of this session read at most ``most`` bytes of files and be given as many of shuffled rows.

    Compressed rows of a few numbers take some thirty times their bytes in an aggregation's table, so that this, and not
    the size of the input, bounds the memory of a task. Settings that are smaller already stay.
    """
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        size, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(name).strip().lower()).groups()
        if int(size) << 10 * " kmgtp".index(unit or " ") > most:
            spark.conf.set(name, str(most))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back, for what would otherwise be worked out twice."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that tasks can import it anywhere."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    home = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(home.rglob("*.py")):
            archive.write(file, file.relative_to(home.parent))
    # addPyFile serves a file of the driver to the executors; no executor reads this path itself.
    path = os.path.join(tempfile.mkdtemp(prefix="cartwheel-ship-"), "cartwheel.zip")
    Path(path).write_bytes(packed.getvalue())
    context.addPyFile(path)
    _shipped.add(context.applicationId)
