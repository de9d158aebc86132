"""Near copies by wide SimHash fingerprints: the rows of texts that say nearly the same go, but one."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import numbered, python_ready, slices, unused, whole_text, written
from cartwheel.llm.components import components
from cartwheel.llm.simhash import SEED, TILE, compare
from cartwheel.llm.words import Words

SHINGLE, SIMILARITY = 5, 0.8
WORDS = ("w0", "w1", "w2", "w3")
BITS = 64 * len(WORDS)
#: Chance that two texts whose shingles have a Jaccard similarity of ``SIMILARITY`` meet in some table; fingerprints
#: per bucket, roughly, in a table.
MEET, BUCKET = 0.95, 64
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: One for each word of a fingerprint, so that a shingle's hash gives it bits of its own.
STEPS = np.arange(1, len(WORDS) + 1, dtype=np.uint64) * M1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def _fold(parts) -> np.ndarray:
    """Hashes of sequences from the hashes of their words; the order counts."""
    out = np.zeros_like(parts[0])
    for part in parts:
        out = _mix(out * M1 + part)
    return out


def wide_mark(shingles: np.ndarray) -> np.ndarray:
    """``BITS`` bits, as words: each is set if it is in over half of the hashes of distinct shingles.

    Every second bit is set where exactly half have it, so that texts of few shingles keep their distances. Without
    shingles no bit is set.
    """
    n = len(shingles)
    if not n:
        return np.zeros(len(WORDS), np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 255 * 256):
        part = shingles[at : at + 255 * 256]
        wide = _mix(part[:, None] + STEPS)
        bits = np.unpackbits(wide.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little")
        # Sums of 255 rows fit into a byte.
        whole = len(part) // 255 * 255
        counts += bits[:whole].reshape(-1, 255, BITS).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
        counts += bits[whole:].sum(0, dtype=np.uint8)
    set_ = (2 * counts > n) | ((2 * counts == n) & (np.arange(BITS) % 2 == 1))
    return np.packbits(set_, bitorder="little").view(np.uint64)


def text_marks(column: pa.Array, size: int = SHINGLE) -> np.ndarray:
    """A row of words for each text: lower-case A-Z, words apart at blanks, distinct shingles of ``size`` words (fewer
    words: the whole sequence)."""
    words = Words(pc.ascii_lower(column))
    symbols, distinct = words.symbols()
    hashes = np.array([xxhash.xxh64_intdigest(w, SEED) for w in distinct.cast(pa.binary()).to_pylist()], np.uint64)[symbols]
    n = max(0, len(hashes) - size + 1)
    rolled = _fold([hashes[k : k + n] for k in range(size)]) if n else hashes[:0]
    out = np.zeros((len(words.counts), len(WORDS)), np.uint64)
    ends = np.cumsum(words.counts)
    for i, (count, end) in enumerate(zip(words.counts.tolist(), ends.tolist())):
        start = end - count
        if count >= size:
            own = np.sort(rolled[start : end - size + 1])
            out[i] = wide_mark(own[np.r_[True, own[1:] != own[:-1]]])
        elif count:
            out[i] = wide_mark(_fold([hashes[k : k + 1] for k in range(start, end)]))
    return out


def wide_marks(docs: DataFrame, key: str, size: int = SHINGLE) -> DataFrame:
    """``key``, doc_id and the fingerprint's words of every row of ``docs``; texts do not move."""
    python_ready(docs.sparkSession)

    def run(batches):
        for part in slices(batches):
            marks = text_marks(part.column("text"), size)
            yield pa.RecordBatch.from_arrays(
                [part.column(key), part.column("doc_id")] + [pa.array(np.ascontiguousarray(w).view(np.int64)) for w in marks.T],
                names=[key, "doc_id", *WORDS],
            )

    source = docs.select(F.col(key).cast("long").alias(key), F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return source.mapInArrow(run, f"{key} long, doc_id long, " + ", ".join(f"{w} long" for w in WORDS))


def radius_of(similarity: float) -> int:
    """Bits in which fingerprints of texts with that cosine similarity differ on average."""
    return int(BITS * math.acos(similarity) / math.pi)


def table_masks(nodes: int, similarity: float = SIMILARITY, meet: float = MEET, bucket: int = BUCKET) -> list[list[int]]:
    """Masks (a signed number for each word) of the bits that make the buckets of each table.

    Buckets hold about ``bucket`` of ``nodes`` fingerprints. Sets of shingles with a Jaccard similarity s have a cosine
    of 2s/(1+s) at least, hence a chance that a bit agrees; there are as many tables as it takes that they meet in one
    with chance ``meet``. Tables take their bits one after the other from shuffled orders of all bits.
    """
    width = min(48, max(4, round(math.log2(max(nodes, 2) / bucket))))
    agree = 1 - math.acos(2 * similarity / (1 + similarity)) / math.pi
    tables = math.ceil(math.log(1 - meet) / math.log(1 - agree**width)) if similarity < 1 else 1
    rng, order, out = np.random.default_rng(SEED), [], []
    while len(out) < tables:
        if len(order) < width:
            order = rng.permutation(BITS).tolist()
        chosen, order = order[:width], order[width:]
        masks = [sum(1 << (b & 63) for b in chosen if b >> 6 == w) for w in range(len(WORDS))]
        out.append([m - (1 << 64) if m >> 63 else m for m in masks])
    return out


def near_links(nodes: DataFrame, similarity: float = SIMILARITY, tile: int = TILE) -> DataFrame:
    """Links (a, b) between rows (node, w0..w3) that connect those within the radius of ``similarity`` that meet.

    ``nodes`` has each fingerprint once and is read several times. A bucket of more than ``tile`` fingerprints is cut
    into tiles by hash and each pair of its tiles is compared in a task of its own; what leaves a comparison is a
    spanning forest, not its pairs. Only counts of buckets are known elsewhere, and just those above ``tile`` kept.
    """
    keys = [
        F.xxhash64(F.lit(t), *[F.col(w).bitwiseAND(F.lit(m)) for w, m in zip(WORDS, masks) if m])
        for t, masks in enumerate(table_masks(nodes.count(), similarity))
    ]
    rows = nodes.select("node", *WORDS, F.explode(F.array(*keys)).alias("bucket"))
    hot = written(
        rows.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > tile)
        .select("bucket", F.ceil(F.col("n") / tile).cast("int").alias("tiles")),
        "near-hot",
    )
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    paired = (
        rows.join(hot, "bucket", "left")
        .withColumn("tiles", F.coalesce("tiles", F.lit(1)))
        .withColumn("own", own)
        .select("node", *WORDS, "bucket", "own", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
        .select("node", *WORDS, "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    dealt = paired.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")
    return dealt.mapInArrow(compare(radius_of(similarity), 2 * tile, WORDS, "node"), "a long, b long").distinct()


def with_bit(rows: DataFrame, key: str, chosen: DataFrame) -> DataFrame:
    """``rows`` whose number ``key`` (>= 0) is in the column ``row`` of ``chosen``.

    The numbers meet as bitmaps of 32,768, an eighth of a byte for each row: as long as the planner finds those small
    enough to broadcast, the rows themselves, which hold whole texts, stay where they are.
    """
    bucket, bits = unused(rows, "__bucket"), unused(rows, "__bits")
    maps = written(
        chosen.groupBy(F.expr("bitmap_bucket_number(row)").alias(bucket)).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(row))").alias(bits)),
        "near-kept",
    )
    place = f"bitmap_bit_position(`{key}`)"
    byte = F.expr(f"cast(conv(hex(substring(`{bits}`, cast({place} div 8 as int) + 1, 1)), 16, 10) as long)")
    held = F.call_function("getbit", byte, F.expr(f"cast({place} % 8 as int)")) == 1
    number: Column = F.expr(f"bitmap_bucket_number(`{key}`)")
    return rows.join(maps, number == maps[bucket]).where(held).select(*[rows[f"`{c}`"] for c in rows.columns])


def drop_near_copies(docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the least doc_id (the first of repeated rows; no
    doc_id counts as largest), all columns kept.

    Texts are near copies if their fingerprints of 256 bits over distinct ``size``-word shingles differ in no more bits
    than a cosine similarity of ``similarity`` gives on average (52 for 0.8; shingle sets with a Jaccard similarity of
    0.8 differ in 39 on average, with 0.5 in 69). Groups are connected through any chain. Bits are compared in tables of
    buckets in which texts of that Jaccard similarity meet with a chance of 0.95 at least, closer ones more surely. Texts
    without words, null ones too, are near copies of each other. A null doc_id, repeated rows and empty tables are fine.
    """
    key = unused(docs, "__row")
    placed = numbered(docs, "near-docs", key)
    marks = wide_marks(placed.select(F.col(key).alias("__row"), "doc_id", "text"), "__row", size)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("__row").alias("row"))).alias("first")
    # The best row of a fingerprint names it, so however many rows share one, they are a single node.
    nodes = written(marks.groupBy(*WORDS).agg(first).select(F.col("first.row").alias("node"), "first", *WORDS), "near-marks")
    roots = components(near_links(nodes.select("node", *WORDS), similarity))
    keep = (
        nodes.select("node", "first")
        .join(roots, "node", "left")
        .groupBy(F.coalesce("root", "node").alias("root"))
        .agg(F.min("first").alias("first"))
        .select("first.row")
    )
    return with_bit(placed, key, keep).drop(key)
