"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import whole_text, written
from cartwheel.llm.fixed import literal_rows

SHARDS, BLOCKS, SPREAD, CELLS, SEED = 16, 4096, 16, 64, 20


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, taken: int) -> int:
    """How many of ``taken`` draws without return are good, for populations of any size.

    Inversion over the counts within twelve standard deviations of the mean; what lies beyond has a probability below
    1e-30. Logarithms of the ratios of neighbouring probabilities are summed outwards from the lower end.
    """
    low, high = max(0, taken - bad), min(good, taken)
    if low == high:
        return low
    total = good + bad
    mean = taken * good / total
    spread = math.sqrt(max(1.0, mean * (bad / total) * ((total - taken) / max(1, total - 1))))
    low, high = max(low, math.floor(mean - 12 * spread - 12)), min(high, math.ceil(mean + 12 * spread + 12))
    k = np.arange(low, high, dtype=np.float64)
    ratio = np.log(good - k) + np.log(taken - k) - np.log(k + 1) - np.log(bad - taken + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(ratio)])
    upto = np.cumsum(np.exp(weight - weight.max()))
    return low + int(np.searchsorted(upto, rng.random() * upto[-1], side="right").clip(0, high - low))


def communication_matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows of each block that go to each shard: row sums are ``counts``, column sums differ by one at most.

    Drawn as a uniform shuffle of all rows would give them: block after block, each shard's share in turn is
    hypergeometric in the places that the shards have left.
    """
    rng = np.random.default_rng(seed)
    total = sum(counts)
    left = [total // shards + (s < total % shards) for s in range(shards)]
    out = np.zeros((len(counts), shards), np.int64)
    for b, n in enumerate(counts):
        places = sum(left)
        for s in range(shards):
            others = places - left[s]
            k = n if others == 0 else draw_hypergeometric(rng, left[s], others, n)
            out[b, s] = k
            places, n = others, n - k
        left = [c - int(k) for c, k in zip(left, out[b])]
    return out


def shuffle_into_shards(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, blocks: int = BLOCKS, cells: int = CELLS
) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus one), text_crc32, shard and slot of every row of ``docs``.

    Each shard gets floor or ceil of rows / shards, slots run from 0 without gaps, and each order of the rows is as
    likely as any other but for the quality of the 64-bit hash. A null text is empty; null ids, repeated rows (each has
    its own slot) and an empty table are fine; other columns are ignored. The same table and seed give the same result
    as long as the table is read in the same partitions.

    1. Each input partition is cut into ``SPREAD`` blocks (at most ``blocks`` in all) and only ids, sizes and checksums
       are written; texts never move.
    2. The driver draws the matrix from the blocks' counts: blocks x shards numbers, whatever the number of rows.
    3. Blocks are permuted locally, each on its own; the first so many rows of the permutation go to shard 0, and so on.
    4. Rows are exchanged and permuted again: a shard is cut into ``cells`` by hash, each cell is ordered on its own,
       and a cell's slots begin behind those of the cells before it.
    """
    spark = docs.sparkSession
    # Rows equal in all columns are rows of their own, so the number of a row decides, not what it holds.
    mark = F.xxhash64("number", F.lit(seed))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(whole_text()).cast("long") + 1).alias("size"),
        F.crc32(whole_text().cast("binary")).alias("text_crc32"),
        (F.spark_partition_id() * SPREAD).alias("part"),
        F.monotonically_increasing_id().alias("number"),
    ).withColumn("mark", mark)
    placed = written(
        rows.withColumn("block", F.pmod(F.col("part") + F.pmod("mark", F.lit(SPREAD)), F.lit(blocks)).cast("int")).drop("part", "number"),
        "shards-blocks",
    )
    counts = {r.block: r.n for r in placed.groupBy("block").agg(F.count("*").alias("n")).collect()}
    order = sorted(counts)
    matrix = communication_matrix([counts[b] for b in order], shards, seed)
    bounds = literal_rows(
        spark,
        [{"block": b, "upto": np.cumsum(matrix[i]).tolist()} for i, b in enumerate(order)],
        "block int, upto array<bigint>",
    )
    local = Window.partitionBy("block").orderBy("mark", "doc_id", "text_crc32", "size")
    # At most ``blocks`` rows of ``shards`` numbers.
    dealt = (
        placed.withColumn("rank", F.row_number().over(local) - 1)
        .join(F.broadcast(bounds), "block")
        .withColumn("shard", F.size(F.filter("upto", lambda u: u <= F.col("rank"))).cast("int"))
    )
    again = written(
        dealt.withColumn("mark", F.xxhash64(F.lit(seed + 1), "block", "rank"))
        .withColumn("cell", F.pmod("mark", F.lit(cells)).cast("int"))
        .select("doc_id", "size", "text_crc32", "shard", "cell", "mark"),
        "shards-dealt",
    )
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = again.groupBy("shard", "cell").agg(F.count("*").alias("n")).select(
        "shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("offset")
    )
    inside = Window.partitionBy("shard", "cell").orderBy("mark", "doc_id", "text_crc32")
    # One row per shard and cell.
    return (
        again.withColumn("place", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), ["shard", "cell"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("place")).alias("slot"))
    )
