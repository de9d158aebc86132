"""Prefix trie of conversations: one node for each distinct beginning, with sums over subtrees."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import python_ready, written
from cartwheel.plans.skew import number_in_group

#: Least number of members above which a node belongs to the top part of the trie; nodes of one shard; numbers hashed
#: per row of text; rows of turns for which the top part has at most one node each.
HEAVY, SHARD, CHUNK, TOP = 2048, 8192, 10_000, 1 << 20
SEEDS = 4
WORDS = "[^\\x20\\x09-\\x0D]+"


def clean_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), n_turns, role and text by turn, a null turn first; ties by role, then text."""
    clean = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    placed = number_in_group(clean, ["conv_id"], ["turn", "role", "text"])
    return placed.select("conv_id", F.col("rn").alias("place"), F.col("group_rows").alias("n_turns"), "role", "text")


def with_shared_heads(placed: DataFrame, head: Column, base: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, role, text) and lengths (conv_id, n_turns) of conversations that begin as others do.

    The first ``head`` turns of a conversation (an expression over conv_id, at most ``most``) are replaced by those of
    conversation ``base`` (likewise): all it has if it has fewer, none if it isn't there.
    """
    convs = placed.groupBy("conv_id").agg(F.max("n_turns").alias("n_turns")).withColumns({"head": head, "base": base})
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("_base_turns"))
    known = written(
        convs.join(lengths, "base", "left").select(
            "conv_id", "base", "n_turns", "head", F.least("head", F.coalesce("_base_turns", F.lit(0))).cast("long").alias("given")
        ),
        "trie-heads",
    )
    own = (
        placed.drop("n_turns")
        .join(known.select("conv_id", "head", "given"), "conv_id")
        .where("place > head")
        .select("conv_id", (F.col("place") - F.col("head") + F.col("given")).alias("depth"), "role", "text")
    )
    first = placed.where(F.col("place") <= most).select(F.col("conv_id").alias("base"), "place", "role", "text")
    given = first.join(known.select("conv_id", "base", "head"), "base").where("place <= head")
    turns = own.unionByName(given.select("conv_id", F.col("place").alias("depth"), "role", "text"))
    size = F.col("given") + F.greatest(F.col("n_turns") - F.col("head"), F.lit(0))
    return turns, known.select("conv_id", size.alias("n_turns"))


def running_sums(df: DataFrame, key: str, order: str, sums: dict[str, str], name: str) -> DataFrame:
    """``df`` with a sum for each of ``sums`` (new column: column) over the rows of ``key`` up to this one by ``order``.

    Rows lie in range partitions of key and order, which cut any group, are summed there, and the sums of a group's
    earlier partitions are added. ``order`` is unique within a key; neither is null.
    """
    ranged = written(df.repartitionByRange(key, order).withColumn("_part", F.spark_partition_id()), name)
    here = Window.partitionBy("_part", key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    pieces = ranged.groupBy("_part", key).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = pieces.select(
        "_part", key, F.count(F.lit(1)).over(earlier).alias("_n"), *[F.sum(f"_{n}").over(earlier).alias(f"_{n}") for n in sums]
    ).where("_n > 0")
    summed = ranged.withColumns({n: F.sum(c).over(here) for n, c in sums.items()})
    total = [(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in sums]
    return summed.join(before, ["_part", key], "left").select(*df.columns, *total)


def _lane(digest: str, at: int) -> Column:
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)")


def _key(depth, a, b) -> Column:
    return F.md5(F.concat_ws(":", depth.cast("string"), a.cast("decimal(38,0)").cast("string"), b.cast("decimal(38,0)").cast("string")))


def prefix_steps(turns: DataFrame, seed: int) -> DataFrame:
    """conv_id, depth, key, parent, turn, n_words: the prefix that each turn completes, and the one before it.

    The key of a prefix stands for two sums over its turns of hashes of place and turn, so that the keys of a long
    conversation need no chain of hashes in one task. Whether different prefixes share a key is checked afterwards.
    """
    turn = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    hashed = turns.select(
        "conv_id", "depth", turn.alias("turn"), F.regexp_count("text", F.lit(WORDS)).cast("long").alias("n_words")
    ).withColumn("_h", F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("depth").cast("string"), "turn"), 256))
    lanes = hashed.select("conv_id", "depth", "turn", "n_words", _lane("_h", 1).alias("a"), _lane("_h", 17).alias("b"))
    summed = running_sums(lanes, "conv_id", "depth", {"sum_a": "a", "sum_b": "b"}, "trie-turns")
    return summed.select(
        "conv_id",
        "depth",
        _key(F.col("depth"), F.col("sum_a"), F.col("sum_b")).alias("key"),
        _key(F.col("depth") - 1, F.col("sum_a") - F.col("a"), F.col("sum_b") - F.col("b")).alias("parent"),
        "turn",
        "n_words",
    )


ROOT = hashlib.md5(b"0:0:0").hexdigest()


def distinct_prefixes(turns: DataFrame, lengths: DataFrame, seeds: int = SEEDS) -> tuple[DataFrame, DataFrame]:
    """All steps, and a node for each distinct prefix: key, parent, depth, conv_id (least member), n_convs, n_words.

    Members of a node must agree on depth, last turn (sha256) and parent node; by induction they then agree on every
    turn. Where they don't, two prefixes share a key, and the keys are made anew with another seed.
    """
    for seed in range(seeds):
        steps = written(prefix_steps(turns, seed), "trie-steps")
        same = [F.min(c).eqNullSafe(F.max(c)) for c in ("depth", "parent", "turn")]
        nodes = written(
            steps.groupBy("key").agg(
                F.min("parent").alias("parent"),
                F.min("depth").alias("depth"),
                F.min("conv_id").alias("conv_id"),
                F.count(F.lit(1)).alias("n_convs"),
                F.min("n_words").alias("n_words"),
                (same[0] & same[1] & same[2]).alias("_one"),
            ),
            "trie-nodes",
        )
        if nodes.where("not _one").isEmpty():
            root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
            root = root.select(
                F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"),
                "conv_id", "n_convs", F.lit(0).cast("long").alias("n_words"),
            )
            return steps, nodes.drop("_one").unionByName(root)
    raise RuntimeError("prefixes keep sharing keys")


class SlotTable:
    """Minimal perfect hash of distinct 128-bit digests to 0..n-1, checked against the digest kept in each slot.

    A level has two places per digest that is left; a digest alone at its place has found it, the others go on to the
    next level. The slot is the number of taken places before that one.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray):
        left, base, self.levels = np.arange(len(high)), 0, []
        self.slots = np.full(len(high), -1, np.int64)
        while len(left):
            if len(self.levels) == 64:
                raise ValueError("a digest is there twice")
            at = self._place(high[left], low[left], len(self.levels), 2 * len(left))
            alone = np.bincount(at, minlength=2 * len(left)) == 1
            rank = base + np.cumsum(alone) - 1
            self.levels.append((alone, rank))
            placed = alone[at]
            self.slots[left[placed]] = rank[at[placed]]
            base += int(placed.sum())
            left = left[~placed]
        self.high, self.low = np.empty_like(high), np.empty_like(low)
        self.high[self.slots], self.low[self.slots] = high, low
        if not (np.array_equal(self.high[self.slots], high) and np.array_equal(self.low[self.slots], low)):
            raise ValueError("two digests share a slot")

    @staticmethod
    def _place(high, low, level, size):
        x = high ^ (low + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 for one that isn't in the table."""
        out = np.full(len(high), -1, np.int64)
        for level, (alone, rank) in enumerate(self.levels):
            open_ = np.flatnonzero(out < 0)
            at = self._place(high[open_], low[open_], level, len(alone))
            slot = np.where(alone[at], rank[at], 0)
            right = alone[at] & (self.high[slot] == high[open_]) & (self.low[slot] == low[open_])
            out[open_[right]] = slot[right]
        return out


def _halves(column) -> tuple[np.ndarray, np.ndarray]:
    """Hexadecimal digests as two 64-bit numbers; a null one as zeros."""
    raw = b"".join(bytes.fromhex(x) if x else bytes(16) for x in column.to_pylist())
    both = np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def accumulate(high, low, parent_high, parent_low, depth, values: list[np.ndarray]) -> list[np.ndarray]:
    """Sums of each value over the subtrees of the given nodes; a parent that isn't among them is left out.

    Nodes get slots, values are scattered into flat arrays by slot, and each depth, the deepest first, is added to the
    slots of its parents.
    """
    table = SlotTable(high, low)
    up = np.empty(len(high), np.int64)
    up[table.slots] = table.find(parent_high, parent_low)
    level = np.empty(len(high), np.int64)
    level[table.slots] = depth
    sums = []
    for value in values:
        flat = np.empty(len(high), np.int64)
        flat[table.slots] = value
        sums.append(flat)
    order = np.argsort(-level, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(level[order])) + 1) if len(order) else ():
        part = part[up[part] >= 0]
        for flat in sums:
            np.add.at(flat, up[part], flat[part])
    return [flat[table.slots] for flat in sums]


SUMS = "name string, sub_saved long, sub_leaves long"


def _accumulate_shard(table: pa.Table) -> pa.Table:
    columns = {c: table.column(c).combine_chunks() for c in table.column_names}
    numbers = [columns[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("bottom", "saved", "leaves")]
    sums = accumulate(*_halves(columns["name"]), *_halves(columns["above"]), numbers[0], numbers[1:])
    return pa.table([columns["name"], *map(pa.array, sums)], names=[c.split()[0] for c in SUMS.split(", ")])


def subtree_sums(stems: DataFrame, steps: DataFrame, nodes: DataFrame, heavy: int, shard: int) -> DataFrame:
    """name, sub_saved, sub_leaves for every stem (name, above, bottom, owner, n_convs, saved, leaves).

    Nodes with over ``heavy`` members are the top of the trie, at most one for each ``heavy`` rows of turns. What hangs
    below it is subtrees with at most ``heavy`` members, hence twice as many stems; each goes whole into a shard of
    about ``shard`` stems. Shards are summed in tasks of their own, their totals go to the stems of the top above
    them, and the top is summed last.
    """
    below = stems.where(F.col("n_convs") <= heavy)
    top = stems.where(F.col("n_convs") > heavy)
    crowded = nodes.where(F.col("n_convs") > heavy).select("key")
    # The first step of a conversation at a node that isn't crowded names the subtree it is in.
    unit = (
        steps.join(crowded, "key", "left_anti")
        .groupBy(F.col("conv_id").alias("owner"))
        .agg(F.min_by("key", "depth").alias("unit"))
    )
    n_shards = max(1, -(-below.count() // shard))
    whole = top.isEmpty()
    dealt = below.withColumn("unit", F.lit(ROOT)) if whole else below.join(unit, "owner")
    columns = ["name", "above", "bottom", "saved", "leaves"]
    dealt = dealt.select(*columns, F.pmod(F.xxhash64("unit"), F.lit(n_shards)).alias("_shard"))
    low = written(dealt.groupBy("_shard").applyInArrow(_accumulate_shard, SUMS), "trie-low")
    if whole:
        return low
    hung = (
        below.join(low, "name")
        .join(top.select(F.col("name").alias("above")), "above", "left_semi")
        .groupBy(F.col("above").alias("name"))
        .agg(F.sum("sub_saved").alias("more_saved"), F.sum("sub_leaves").alias("more_leaves"))
    )
    filled = top.join(hung, "name", "left").select(
        "name",
        "above",
        "bottom",
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
        F.lit(0).alias("_shard"),
    )
    return low.union(written(filled.groupBy("_shard").applyInArrow(_accumulate_shard, SUMS), "trie-top"))


def _hash_lists(batches):
    """Rows come sorted by key and chunk; one digest per key of its chunks, joined by commas."""
    key, digest = None, None
    for batch in batches:
        keys, shas = [], []
        for name, chunk in zip(batch.column("key").to_pylist(), batch.column("listed").to_pylist()):
            if name != key:
                if key is not None:
                    keys.append(key)
                    shas.append(digest.hexdigest())
                key, digest = name, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(chunk.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(shas, pa.string())], names=["key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])


def ends(steps: DataFrame, lengths: DataFrame) -> DataFrame:
    """key and ends_sha256 of nodes where conversations end, their numbers ascending.

    Numbers are joined to texts of ``CHUNK`` in tasks of their own; what remains for one task is to hash the texts of
    a node in order, as they come.
    """
    last = steps.select("conv_id", "depth", "key").join(lengths, "conv_id").where("depth = n_turns").select("key", "conv_id")
    nowhere = lengths.where("n_turns = 0").select(F.lit(ROOT).alias("key"), "conv_id")
    placed = number_in_group(last.union(nowhere), ["key"], ["conv_id"])
    chunks = placed.groupBy("key", F.expr(f"(rn - 1) div {CHUNK}").alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("listed")
    )
    return chunks.repartition("key").sortWithinPartitions("key", "chunk").select("key", "listed").mapInArrow(
        _hash_lists, "key string, ends_sha256 string"
    )


def prefix_trie(turns: DataFrame, lengths: DataFrame, heavy: int = HEAVY, shard: int = SHARD) -> DataFrame:
    """A row for each distinct prefix of the given conversations, the textless root included.

    ``turns`` has conv_id, depth (1, 2, ... without a gap), role and text; ``lengths`` has every conv_id once with
    n_turns. Returned are conv_id (least member), depth, parent_conv_id (null for the root), n_convs (members),
    n_children, n_leaves and saved_tokens (over the subtree), ends_sha256. No conversations give no rows.

    Members that go on together make one stem: a chain of nodes with equal members, named by its lowest node. Stems
    are at most twice as many as conversations, however long these are; sums within a stem are running sums, sums over
    subtrees of stems are taken in shards (``subtree_sums``).
    """
    python_ready(turns.sparkSession)
    steps, nodes = distinct_prefixes(turns, lengths)
    kids = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("n_children"), F.max("n_convs").alias("_most")
    )
    full = nodes.join(kids, "key", "left").select(
        "key", "parent", "depth", "conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("n_words")).alias("own"),
        F.when(F.coalesce("_most", F.lit(0)) < F.col("n_convs"), 1).otherwise(0).cast("long").alias("lowest"),
    )
    # A node's least member is the least member of the nodes below it on its path, so nodes of one are a chain.
    chained = written(
        running_sums(full, "conv_id", "depth", {"upto": "own", "stems": "lowest"}, "trie-chains").withColumn(
            "stem", F.col("stems") - F.col("lowest")
        ),
        "trie-chained",
    )
    n_rows = steps.count()
    heavy = max(heavy, n_rows // TOP)
    stems = written(
        chained.groupBy(F.col("conv_id").alias("owner"), "stem").agg(
            F.max_by("key", "depth").alias("name"),
            F.min_by("parent", "depth").alias("above"),
            F.max("depth").alias("bottom"),
            F.max("n_convs").alias("n_convs"),
            F.sum("own").alias("saved"),
            F.max("upto").alias("stem_upto"),
            F.min("n_children").alias("_least_children"),
        ).withColumn("leaves", F.when(F.col("_least_children") == 0, 1).otherwise(0).cast("long")),
        "trie-stems",
    )
    sums = stems.join(subtree_sums(stems, steps, nodes, heavy, shard), "name")
    known = sums.select(F.col("owner").alias("conv_id"), "stem", "sub_saved", "sub_leaves", "saved", "stem_upto")
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        chained.join(known, ["conv_id", "stem"])
        .join(above, "parent", "left")
        .join(ends(steps, lengths), "key", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("sub_leaves").alias("n_leaves"),
            (F.col("sub_saved") - F.col("saved") + F.col("stem_upto") - F.col("upto") + F.col("own")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )
