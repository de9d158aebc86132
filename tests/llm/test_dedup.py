"""Exact and near copies, and benchmark passages, against plain loops."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from small import docs_of, other_splits, stored  # noqa: F401 - fixtures

from cartwheel.llm import decontam, exact, quality, queries, simhash
from cartwheel.llm.components import components


def same(df, expected, *columns):
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


@pytest.fixture(scope="module")
def some(spark):
    return [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]


ODD = [(1, None), (2, ""), (None, ""), (3, "a b c"), (3, "a b c"), (4, "a b c"), (None, "x"), (5, "é" * 200_000), (6, "é" * 200_000)]


@pytest.mark.parametrize("digest", [None, lambda text: F.length(text).cast("string")])
def test_exact_against_loops(stored, some, digest):
    for pairs in (some + ODD, ODD, []):
        groups = exact.exact_groups(stored(pairs), digest)
        expected = [row[:3] for row in brute.exact(pairs)]
        same(groups, expected, "doc_id", "keep_id", "group_size")
        kept = groups.where("kept")
        assert kept.count() == len({t or "" for _, t in pairs})
        assert kept.where("not keep_id <=> doc_id").count() == 0


def test_exact_hot_text(stored):
    pairs = [(i, "hot" if i % 3 else f"text {i}") for i in range(600)]
    groups = exact.exact_groups(stored(pairs, 8), salts=4)
    same(groups, [row[:3] for row in brute.exact(pairs)], "doc_id", "keep_id", "group_size")


def test_exact_flushes_locally(stored, monkeypatch):
    monkeypatch.setattr(exact, "HELD_BYTES", 1)
    pairs = [(i, f"t{i % 7}") for i in range(100)]
    same(exact.exact_groups(stored(pairs)), [row[:3] for row in brute.exact(pairs)], "doc_id", "keep_id", "group_size")


def test_drop_exact_copies_keeps_columns(stored):
    docs = stored(ODD)
    left = exact.drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert {r.text or "" for r in left.collect()} == {t or "" for _, t in ODD} and left.count() == 4


@pytest.mark.parametrize("stage", ["exact", "simhash", "quality"])
def test_stages_hold_if_the_second_scan_is_dealt_otherwise(spark, stored, other_splits, stage):
    pairs = [(i, f"good words number {i % 30} " * 20 if i % 2 else f"bad {i % 30} junk " * 20) for i in range(240)]
    docs = stored(pairs, 6)
    parts = docs.rdd.getNumPartitions()
    if stage == "quality":
        labels = spark.createDataFrame([(i, i % 2) for i, _ in pairs], "doc_id long, quality int")
        left = quality.drop_low_quality(docs, labels)
        want = {i for i, _ in pairs if i % 2}
        assert "monotonically" not in left._jdf.queryExecution().analyzed().toString()
    elif stage == "exact":
        left, want = exact.drop_exact_copies(docs), set(range(210, 240))
    else:
        left = simhash.drop_near_copies(docs)
        want = {row[2] for row in brute.near_components(pairs)}
    other_splits()
    assert docs.select("doc_id").rdd.getNumPartitions() < parts
    assert sorted(r.doc_id for r in left.collect()) == sorted(want)


BENCH = [(1, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "alpha beta"), (3, "solo"),
         (None, "q w e r t y"), (4, ""), (5, None), (2, "gamma delta"), (7, "one two three four five six seven eight nine ten eleven twelve thirteen")]


def test_contamination_small(spark, stored):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen"
    texts = [None, "", "!!", "solo", "SOLO solo", "alpha-beta gamma", f"x {long} y", f"{long} fourteen {long}", long[4:],
             "w " * 5000 + long, "alpha beta alpha beta", "q w e r t y é", "one two three " * 30, "é solo é", "gamma delta alpha beta"]
    pairs = [(i, t) for i, t in enumerate(texts)] + [(0, "solo"), (None, "alpha beta"), (3, "solo")]
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    found = decontam.contamination(stored(pairs), bench).withColumn("s", F.sha2(F.array_join("items", ","), 256))
    found = found.withColumn("c", decontam.is_contaminated())
    same(found, brute.contamination(pairs, BENCH), "doc_id", "n_words", "n_hit", "n_items", "s", "c")


def test_contamination_empty_tables(spark, stored):
    bench = spark.createDataFrame([], "item_id long, text string")
    found = decontam.contamination(stored([(1, "a b")]), bench)
    assert [tuple(r)[:4] for r in found.collect()] == [(1, 2, 0, 0)]
    assert decontam.contamination(stored([]), bench).count() == 0


def test_contamination_on_table(spark):
    sf = "/root/testdata/sf0.001"
    pairs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    df = queries.QUERIES["op5_benchmark_decontamination"](spark, sf)
    same(df, brute.contamination(pairs, items), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_drop_contaminated(spark, stored):
    docs = stored([(1, "alpha beta"), (1, "clean"), (2, None), (2, None)])
    left = decontam.drop_contaminated(docs, spark.createDataFrame(BENCH, "item_id long, text string"))
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in left.collect() if r.text) == [(1, "clean")] and left.count() == 3


def test_neighbours_are_all_close_pairs():
    rng = np.random.default_rng(3)
    marks = rng.integers(0, 1 << 63, 300, np.uint64)
    near = marks[:150] ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64))
    marks = np.unique(np.r_[marks, near, near[:50] ^ np.uint64(1 << 40)])
    got = np.unpackbits(simhash.neighbours(marks, chunk=64).view(np.uint8), axis=1, bitorder="little")[:, : len(marks)]
    apart = np.array([[int(a ^ b).bit_count() for b in marks] for a in marks])
    other = ~np.eye(len(marks), dtype=bool)
    assert (got.astype(bool) & other == (apart <= 2) & other).all()


@pytest.mark.parametrize("tile", [8, 2048])
def test_near_copies_against_loops(spark, stored, some, tile, monkeypatch):
    monkeypatch.setattr(simhash.close_links, "__defaults__", (2, tile))
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    group = [(1000 + i, " ".join(words[:rng.randrange(200)] + [str(i)] + words[200:])) for i in range(60)]
    pairs = some + group + ODD
    df = simhash.simhash_groups(stored(pairs)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component"
    )
    same(df, brute.near_components(pairs), *df.columns)


def test_chained_fingerprints_make_one_component(spark):
    marks = spark.createDataFrame([((1 << i) - 1,) for i in range(0, 60, 2)] + [(1 << 62,), (-1,)], "fp long")
    links = simhash.close_links(marks, tile=4)
    roots = {r.node: r.root for r in components(links).collect()}
    assert roots == {(1 << i) - 1: 0 for i in range(2, 60, 2)} | {1 << 62: 0}


def test_components_of_long_chain(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components(links).collect()} == {0}
    assert components(links.limit(0)).count() == 0


def test_drop_near_copies(stored):
    docs = stored([(9, "a b c d"), (3, "A b c d"), (3, "a b c d"), (None, "a b c d"), (5, None), (4, "")])
    left = simhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 4]
    assert simhash.drop_near_copies(stored([])).count() == 0


def test_equal_short_rows_are_not_held_whole():
    import pyarrow as pa

    class Everything:
        value = np.full(1 << 10, ~np.uint64(0), np.uint64)

    n, sizes = 200_000, []
    batches = (
        pa.RecordBatch.from_pydict({
            "row": pa.array(range(at, at + 1000), pa.int64()), "doc_id": pa.array(range(at, at + 1000), pa.int64()),
            "text": [""] * 1000, "digest": ["d"] * 1000, "key": pa.array([1] * 1000, pa.int64()),
        })
        for at in range(0, n, 1000)
    )
    for out in exact._local_winners(Everything(), 4 << 20)(batches):
        sizes.append(out.num_rows)
    assert sum(sizes) == n and max(sizes) < 20_000
