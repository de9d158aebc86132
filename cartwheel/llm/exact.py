"""Exact deduplication by skew-safe combining."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import bitmap, in_bitmap, numbered, python_ready, slices, unused, whole_text, written

SALTS = 16
HELD_BYTES = 64 << 20
#: What a member of a group takes in a task's memory, however short its text.
MEMBER_BYTES = 400
LOCAL = "row long, doc_id long, digest string, rep long, n long, text string"


def _better(id_a, row_a, id_b, row_b) -> bool:
    """Larger doc_id first, no doc_id last, then the earlier row."""
    return (id_a is not None, id_a or 0, -row_a) > (id_b is not None, id_b or 0, -row_b)


def _local_winners(repeated, held_bytes: int):
    """Per partition: one winner for each text whose digest may occur more than once; the others point to it."""

    def flush(classes):
        out = []
        for digest, found in classes.items():
            for text, best_id, best_row, members in found:
                out += [
                    (row, doc_id, digest, best_row, len(members) if row == best_row else None, text if row == best_row else None)
                    for row, doc_id in members
                ]
        return batch(out)

    def batch(rows):
        columns = list(zip(*rows)) if rows else [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        names = ("row", "doc_id", "digest", "rep", "n", "text")
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))

    def run(batches):
        words = repeated.value
        classes, held = {}, 0
        for part in slices(batches):
            keys = part.column("key").to_numpy(zero_copy_only=False)
            again = in_bitmap(words, keys)
            ids, rows = part.column("doc_id").to_pylist(), part.column("row").to_pylist()
            digests, contents = part.column("digest").to_pylist(), part.column("text")
            alone = np.flatnonzero(~again)
            if len(alone):
                yield batch([(rows[i], ids[i], digests[i], rows[i], 1, None) for i in alone])
            for i in np.flatnonzero(again):
                text = contents[i].as_py()
                found = classes.setdefault(digests[i], [])
                for entry in found:
                    if entry[0] == text:
                        if _better(ids[i], rows[i], entry[1], entry[2]):
                            entry[1:3] = ids[i], rows[i]
                        entry[3].append((rows[i], ids[i]))
                        held += MEMBER_BYTES
                        break
                else:
                    found.append([text, ids[i], rows[i], [(rows[i], ids[i])]])
                    held += len(text) + 200 + MEMBER_BYTES
            if held > held_bytes:
                yield flush(classes)
                classes, held = {}, 0
        yield flush(classes)

    return run


def exact_groups(docs: DataFrame, digest=None, salts: int = SALTS, key: str | None = None) -> DataFrame:
    """One row per document: row, doc_id, digest, keep_row, keep_id, group_size, kept.

    Texts are equal when all their characters are; a null text is the empty text. The row with the largest doc_id stays
    (no doc_id counts as smallest; of rows with the same doc_id the first in table order). ``docs`` must be a plan that
    gives the same rows again, in any order. An empty table gives no rows; other columns of ``docs`` are ignored.
    ``row`` is the long column ``key``, or else a number that holds within this result only: it is given in one scan.

    1. Digests are counted, which moves digests only. Texts whose digest is certainly alone never move.
    2. Each task compares the other texts of its partition and keeps one winner per text, and starts anew when texts
       and members fill ``HELD_BYTES``, so that a partition of equal short rows is never held whole.
    3. Winners are merged within salted digest groups, a few rows per partition and text, by whole text.
    4. Salt winners are merged within digest groups, at most ``salts`` rows per text, by whole text.
    ``digest`` names another digest, a function from the text column to a string column; a weak one costs time only.
    """
    spark = docs.sparkSession
    python_ready(spark)
    digest = digest or (lambda text: F.sha2(text, 256))
    number = F.col(key) if key else F.monotonically_increasing_id()
    rows = (
        docs.select(number.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
        .withColumn("digest", digest(F.col("text")))
        .withColumn("key", F.xxhash64("digest"))
    )
    again = rows.groupBy("key").count().where("count > 1").select("key")
    repeated = spark.sparkContext.broadcast(bitmap(written(again, "exact-repeated")))
    local = written(rows.mapInArrow(_local_winners(repeated, HELD_BYTES), LOCAL), "exact-local")

    first = F.struct(F.col("doc_id").isNotNull().alias("has"), F.col("doc_id").alias("id"), (-F.col("row")).alias("back"))
    salted = local.where("text is not null").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    group = Window.partitionBy("digest", "salt", "text")
    merged = written(
        salted.select(
            "row",
            "digest",
            F.max(first).over(group).alias("best"),
            F.sum("n").over(group).alias("n"),
            "text",
        ).select(
            "row",
            "digest",
            "best",
            "n",
            F.when(F.col("row") == -F.col("best.back"), F.col("text")).alias("text"),
        ),
        "exact-salted",
    )
    everywhere = Window.partitionBy("digest", "text")
    final = merged.where("text is not null").select(
        F.col("row").alias("salt_row"),
        F.max("best").over(everywhere).alias("top"),
        F.sum("n").over(everywhere).alias("group_size"),
    )
    chain = merged.select(F.col("row").alias("rep"), (-F.col("best.back")).alias("salt_row")).join(final, "salt_row")
    verdict = chain.select("rep", (-F.col("top.back")).alias("keep_row"), F.col("top.id").alias("keep_id"), "group_size")
    alone = F.col("keep_row").isNull()
    return local.select("row", "doc_id", "digest", "rep").join(verdict, "rep", "left").select(
        "row",
        "doc_id",
        "digest",
        F.coalesce("keep_row", "row").alias("keep_row"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.coalesce("keep_row", "row") == F.col("row")).alias("kept"),
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept; see ``exact_groups``."""
    key = unused(docs, "__row")
    placed = numbered(docs, "exact-docs", key)
    losers = exact_groups(placed, key=key).where("not kept").select(F.col("row").alias(key))
    return placed.join(losers, key, "left_anti").drop(key)
