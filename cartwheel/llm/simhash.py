"""SimHash fingerprints and near duplicates by bit-sliced comparison."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import numbered, python_ready, slices, unused, whole_text, written
from cartwheel.llm.components import components

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SHINGLE, RADIUS, SEED = 3, 2, 42
#: Bits 0-63 in five runs; fingerprints with two differing bits agree in three runs at least.
RUNS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
TILE = 2048


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """64 bits; a bit is set if it is in over half of the hashes of the ``size``-word shingles, repeats included."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.r_[0, ends[:-1]][: len(words) - size + 1].tolist()
        stops = (ends[size - 1 :] - 1).tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, stops)]
    counts = np.zeros(64, np.int64)
    every = np.array(hashes, np.uint64)
    for at in range(0, len(every), 1 << 16):
        bits = np.unpackbits(every[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(every), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` and fp (the 64 bits as a long) of every row; null and empty texts have fp 0."""
    python_ready(docs.sparkSession)

    def run(batches):
        for part in slices(batches):
            marks = [fingerprint(t.as_buffer().to_pybytes()) for t in part.column("text")]
            yield pa.RecordBatch.from_arrays([part.column(key), pa.array(np.array(marks, np.uint64).view(np.int64))], names=[key, "fp"])

    source = docs.select(F.col(key).cast("long").alias(key), whole_text().alias("text"))
    return source.mapInArrow(run, f"{key} long, fp long")


def bit_planes(marks: np.ndarray) -> np.ndarray:
    """A row for each bit: that bit of all fingerprints (one or several words each), packed into words of 64 lanes."""
    lanes = -(-len(marks) // 64) * 64
    every = np.unpackbits(np.ascontiguousarray(marks).view(np.uint8).reshape(len(marks), -1), axis=1, bitorder="little")
    bits = np.zeros((lanes, every.shape[1]), np.uint8)
    bits[: len(marks)] = every
    return np.ascontiguousarray(np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")).view(np.uint64)


def neighbours(marks: np.ndarray, radius: int = RADIUS, chunk: int = 256) -> np.ndarray:
    """Bit matrix of the pairs within ``radius`` bits: row i has a lane bit for each fingerprint close to i.

    Distances of one fingerprint to all lanes are counted plane by plane in carry-save counters: one word per binary
    digit of the count, and one that stays set once the count exceeds the radius. Queries all of whose lanes exceed it
    leave before the remaining planes are read. A fingerprint is a word of 64 bits or a row of several.
    """
    planes = bit_planes(marks)
    marks = marks.reshape(len(marks), -1)
    width = planes.shape[1]
    digits = radius.bit_length()
    out = np.zeros((len(marks), width), np.uint64)
    valid = np.full(width, ~np.uint64(0))
    if len(marks) % 64:
        valid[-1] = (np.uint64(1) << np.uint64(len(marks) % 64)) - np.uint64(1)
    for low in range(0, len(marks), chunk):
        mine = np.arange(low, min(low + chunk, len(marks)))
        asked = marks[mine]
        counter = np.zeros((digits, len(mine), width), np.uint64)
        over = np.broadcast_to(~valid, (len(mine), width)).copy()
        for bit in range(len(planes)):
            flip = np.where(asked[:, bit >> 6] >> np.uint64(bit & 63) & np.uint64(1), ~np.uint64(0), np.uint64(0))
            carry = planes[bit][None, :] ^ flip[:, None]
            for d in range(digits):
                counter[d], carry = counter[d] ^ carry, counter[d] & carry
            over |= carry
            if bit % 8 == 7 and bit > max(7, radius):
                over |= _exceeds(counter, radius)
                # A fingerprint always matches itself; one that matches nothing else is through.
                own = np.zeros_like(over)
                own[np.arange(len(mine)), mine >> 6] = np.uint64(1) << (mine & 63).astype(np.uint64)
                live = ((over | own) != ~np.uint64(0)).any(1)
                if not live.all():
                    mine, asked, over, counter = mine[live], asked[live], over[live], counter[:, live]
                    if not len(mine):
                        break
        if len(mine):
            out[mine] = ~(over | _exceeds(counter, radius))
    return out


def _exceeds(counter: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose binary count is larger than ``radius``."""
    more = np.zeros_like(counter[0])
    same = ~more
    for d in range(len(counter) - 1, -1, -1):
        if radius >> d & 1:
            same = same & counter[d]
        else:
            more |= same & counter[d]
            same = same & ~counter[d]
    return more


def spanning_links(marks: np.ndarray, group: np.ndarray, radius: int = RADIUS, names: np.ndarray | None = None):
    """Links (a, b) that connect the fingerprints of each group as their pairs within ``radius`` do; fewer than rows.

    They are told by ``names``, or by the fingerprints themselves.
    """
    names = marks if names is None else names
    close = neighbours(marks, radius)
    width = close.shape[1]
    lane_group = np.r_[group, np.full(width * 64 - len(group), -1)]
    same = np.zeros((len(np.unique(group)), width), np.uint64)
    distinct, code = np.unique(group, return_inverse=True)
    for k, g in enumerate(distinct):
        same[k] = np.packbits(lane_group == g, bitorder="little").view(np.uint64)
    close &= same[code]
    seen = np.zeros(width, np.uint64)
    a, b = [], []
    for i in np.flatnonzero(close.any(1)):
        if seen[i >> 6] >> np.uint64(i & 63) & np.uint64(1):
            continue
        reached = np.zeros(width, np.uint64)
        reached[i >> 6] |= np.uint64(1) << np.uint64(i & 63)
        front = np.array([i])
        while len(front):
            fresh = np.bitwise_or.reduce(close[front], axis=0) & ~reached
            reached |= fresh
            front = np.flatnonzero(np.unpackbits(fresh.view(np.uint8), bitorder="little"))
        members = np.flatnonzero(np.unpackbits(reached.view(np.uint8), bitorder="little"))
        seen |= reached
        a += names[members[1:]].tolist()
        b += [names[members[0]]] * (len(members) - 1)
    return np.array(a, np.uint64).view(np.int64), np.array(b, np.uint64).view(np.int64)


def compare(radius: int, most: int, words: tuple[str, ...] = ("fp",), name: str = "fp"):
    """Rows come sorted by bucket; whole buckets are compared together in blocks of about ``most`` lanes.

    A fingerprint lies in the columns ``words``; links are told by the column ``name``.
    """

    def run(batches):
        held, total = [], 0
        for batch in batches:
            fp = np.stack([batch.column(c).to_numpy() for c in words], 1).view(np.uint64)
            node = batch.column(name).to_numpy().view(np.uint64)
            bucket = np.stack([batch.column(c).to_numpy() for c in ("bucket", "i", "j")], 1)
            held.append((fp, node, bucket))
            total += len(fp)
            if total < 8 * most:
                continue
            fp, node, bucket = (np.concatenate(x) for x in zip(*held))
            last = np.flatnonzero((bucket != bucket[-1]).any(1))
            cut = last[-1] + 1 if len(last) else 0
            yield from blocks(fp[:cut], node[:cut], bucket[:cut])
            held, total = [(fp[cut:], node[cut:], bucket[cut:])], len(fp) - cut
        if held:
            yield from blocks(*(np.concatenate(x) for x in zip(*held)))

    def blocks(fp, node, bucket):
        if not len(fp):
            return
        change = np.r_[True, (bucket[1:] != bucket[:-1]).any(1)]
        group = np.cumsum(change) - 1
        size = np.bincount(group)
        several = size[group] > 1
        fp, node, group = fp[several], node[several], group[several]
        if not len(fp):
            return
        _, group, sizes = np.unique(group, return_inverse=True, return_counts=True)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(fp):
            first = group[at]
            stop = int(ends[max(first, np.searchsorted(ends, at + 256, side="right") - 1)])
            a, b = spanning_links(fp[at:stop], group[at:stop], radius, node[at:stop])
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            at = stop

    return run


def close_links(marks: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints, column fp, that connect all those within ``radius`` <= 2 bits.

    Fingerprints within two bits agree in three of five runs of bits, so each meets the others in ten tables of
    buckets. A bucket of more than ``tile`` fingerprints is cut into tiles by hash, and each pair of its tiles is
    compared by a task of its own; nothing is left out. What leaves a comparison is a spanning forest, not its pairs.
    """
    if radius > 2:
        raise ValueError("five runs of bits serve a radius of two at most")
    tables = []
    for number, runs in enumerate(combinations(RUNS, 3)):
        mask = sum(((1 << size) - 1) << start for start, size in runs)
        signed = mask - (1 << 64) if mask >> 63 else mask
        tables.append(F.struct(F.lit(number).alias("t"), F.col("fp").bitwiseAND(F.lit(signed)).alias("bits")))
    rows = marks.select("fp", F.explode(F.array(*tables)).alias("k")).select("fp", F.xxhash64("k.t", "k.bits").alias("bucket"))
    # Buckets meet by the hash of table and bits; a clash only compares a few fingerprints more.
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    paired = (
        rows.join(counts, "bucket")
        .withColumn("tiles", tiles)
        .withColumn("own", own)
        .select("fp", "bucket", "own", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
        .select("fp", "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    dealt = paired.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "fp")
    return dealt.mapInArrow(compare(radius, 2 * tile), "a long, b long").distinct()


def simhash_groups(docs: DataFrame, radius: int = RADIUS, key: str = "doc_id") -> DataFrame:
    """``key``, fp and component (the least ``key`` of all rows linked through any chain), one row per row of ``docs``.

    Rows link if their fingerprints differ in ``radius`` bits or fewer. Null and empty texts, which have fingerprint
    zero, link with each other and with any text whose fingerprint is close to zero. A row without a key takes part; a
    component whose keys are all null has a null name. Repeated rows give repeated rows; other columns are ignored.
    Fingerprints are written once; texts never move. Groups of equal fingerprints count as one node.
    """
    marks = written(fingerprints(docs, key), "simhash-marks")
    least = written(marks.groupBy("fp").agg(F.min(key).alias("least")), "simhash-distinct")
    roots = components(close_links(least.select("fp"), radius))
    named = least.join(roots, least["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = named.groupBy("root").agg(F.min("least").alias("component"))
    lookup = named.join(names, "root").select("fp", "component")
    return marks.join(lookup, "fp")


def drop_near_copies(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component, the one with the least doc_id (the first of repeated rows; no doc_id
    counts as largest), all columns kept."""
    key = unused(docs, "__row")
    placed = numbered(docs, "simhash-docs", key)
    ranked = placed.select(F.col(key).alias("__row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    groups = simhash_groups(ranked, radius, key="__row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")).alias("first")
    keep = (
        groups.join(ranked.select("__row", "doc_id"), "__row")
        .groupBy("component")
        .agg(first)
        .select(F.col("first.__row").alias(key))
    )
    return placed.join(keep, key, "left_semi").drop(key)
