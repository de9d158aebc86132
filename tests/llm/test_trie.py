"""Conversation prefix trie against a plain dictionary of prefixes, and the slot table."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import check
import numpy as np
import pytest
from brute import sha

from cartwheel.llm import queries, trie

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, last = defaultdict(list), defaultdict(list)
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = tuple(turns.get(c - c % 20, [])[:h] + ts[h:])
        last[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) if kids[k] else 1
        own_words = len(re.findall("[^\x20\x09-\x0d]+", k[-1][1])) if k else 0
        saved[k] = (len(members[k]) - 1) * own_words + sum(saved[x] for x in kids[k])
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k],
         sha(",".join(map(str, sorted(last[k])))))
        for k, m in members.items()
    )


def frame(spark, rows, parts=3):
    schema = "conv_id long, turn long, role string, text string, depth string, key long, conv string"
    return spark.createDataFrame([(*r, "x", 0, None) for r in rows], schema).repartition(parts)


def many(n=300, seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        if c % 7 == 3:
            rows += [(c, t, "u", f"hot {t}") for t in range(6)]
        elif c % 20 == 0 and c % 3 == 0:
            continue
        else:
            rows += [(c, t, ["u", "a", None][int(rng.integers(3))], ["x y", "z", "", None][int(rng.integers(4))]) for t in range(int(rng.integers(1, 7)))]
    rows += [(500, t, "u", f"long {t % 3}") for t in range(400)] + [(501, t, "u", f"long {t % 3}") for t in range(399)]
    rows += [(None, 1, "u", "lost"), (502, None, None, None), (502, None, None, None), (502, -1, "u", "a\x1fb c d")]
    return rows


@pytest.mark.parametrize(("heavy", "shard"), [(trie.HEAVY, trie.SHARD), (20, 50), (1, 10)])
def test_against_plain(spark, heavy, shard, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 7)
    rows = many()
    placed = trie.clean_turns(frame(spark, rows))
    from pyspark.sql import functions as F

    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    got = trie.prefix_trie(*trie.with_shared_heads(placed, head, F.col("conv_id") - F.col("conv_id") % 20, 3), heavy, shard)
    assert sorted(map(tuple, got.select(*NAMES).collect())) == plain_trie(rows)


def test_turnless_and_empty(spark):
    assert queries.conversation_trie(frame(spark, [(1, 1, "u", "a")]).limit(0)).count() == 0
    # Conversations shorter than their shared head, without the one to share it with, are without turns.
    short = [c for c in range(41, 60) if zlib.crc32(str(c).encode()) % 4 > 0][:3]
    rows = [(c, 0, "u", "a b") for c in short]
    got = queries.conversation_trie(frame(spark, rows, 1)).select(*NAMES).collect()
    assert sorted(map(tuple, got)) == plain_trie(rows) and got[0].n_convs == 3 and len(got) == 1


def test_shared_keys_are_noticed(spark, monkeypatch):
    real, seeds = trie._lane, []

    def weak(digest, at):
        return real(digest, at) % (2 if len(seeds) < 3 else 1 << 60)

    def steps(turns, seed, made=trie.prefix_steps):
        seeds.append(seed)
        if len(seeds) > 1:
            seeds.extend([None] * 3)
        return made(turns, seed)

    monkeypatch.setattr(trie, "_lane", weak)
    monkeypatch.setattr(trie, "prefix_steps", steps)
    rows = many(60)
    assert sorted(map(tuple, queries.conversation_trie(frame(spark, rows)).select(*NAMES).collect())) == plain_trie(rows)
    assert [s for s in seeds if s is not None] == [0, 1]


def test_slot_table():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        high, low = (rng.integers(0, 1 << 63, n).astype(np.uint64) for _ in range(2))
        table = trie.SlotTable(high, low)
        assert sorted(table.slots.tolist()) == list(range(n))
        assert np.array_equal(table.find(high, low), table.slots)
        assert (table.find(high ^ np.uint64(1), low) == -1).all()
    with pytest.raises(ValueError, match="twice"):
        trie.SlotTable(np.array([5, 5], np.uint64), np.array([7, 7], np.uint64))


def test_query_against_sql(spark, sf_dir):
    name = "op13_conversation_trie"
    ok, note = check.compare(spark, check.connect(sf_dir), name, queries.QUERIES[name], queries.ORACLE[name], sf_dir)
    assert ok and "TYPES" not in note, note
