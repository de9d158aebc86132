"""Near copies by wide fingerprints, against a plain loop over all pairs of texts."""

from __future__ import annotations

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from small import docs_of, stored  # noqa: F401 - fixtures

from cartwheel.llm import near


def edited(words, rng, share):
    return " ".join(rng.choice(words) + "x" if rng.random() < share else w for w in words)


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(8)
    pairs = []
    for base in range(40):
        words = [f"v{rng.randrange(500)}" for _ in range(rng.choice([12, 60, 400]))]
        pairs += [(len(pairs) + k, edited(words, rng, 0 if k == 0 else 0.01)) for k in range(4)]
    crowd = [f"v{rng.randrange(500)}" for _ in range(300)]
    pairs += [(1000 + k, edited(crowd, rng, 0.002)) for k in range(120)]
    return pairs + [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one"), (2004, "One"), (2005, "two")]


def test_marks_follow_the_share_of_common_shingles():
    rng = random.Random(1)
    words = [f"v{rng.randrange(9000)}" for _ in range(600)]
    half = words[:300] + [f"u{k}" for k in range(300)]
    a, b, c, d = near.text_marks(pa.array([" ".join(words), " ".join(words).upper(), " ".join(half), "other"]))
    assert (a == b).all()
    # A cosine of one half means a third of all bits.
    assert 60 < sum(int(x).bit_count() for x in a ^ c) < 110
    assert 95 < sum(int(x).bit_count() for x in a ^ d) < 160
    assert not near.text_marks(pa.array(["", " \n"])).any()
    assert near.radius_of(0.8) == 52


def test_marks_of_many_shingles_are_counted_in_parts():
    shingles = np.arange(200_001, dtype=np.uint64) * near.M2
    bits = np.zeros(near.BITS, np.int64)
    for k, step in enumerate(near.STEPS):
        mixed = near._mix(shingles + step)
        bits[64 * k : 64 * k + 64] = [int((mixed >> np.uint64(b) & np.uint64(1)).sum()) for b in range(64)]
    want = np.packbits(2 * bits > len(shingles), bitorder="little").view(np.uint64)
    assert (near.wide_mark(shingles) == want).all()


@pytest.mark.parametrize("tile", [16, 2048])
def test_one_of_each_group_stays(stored, copies, tile, monkeypatch):
    monkeypatch.setattr(near.near_links, "__defaults__", (near.SIMILARITY, tile))
    docs = stored(copies)
    left = near.drop_near_copies(docs)
    assert left.columns == docs.columns
    got = sorted(r.doc_id for r in left.collect())
    want = brute.near_left(copies)
    # Texts that meet in no table may both stay; none goes without a near copy.
    assert set(want) <= set(got) and len(got) <= len(want) + 2
    assert len(want) < 60


def test_tables_follow_the_number_of_texts():
    few, many = near.table_masks(1000), near.table_masks(10**7)
    width = [{sum((m & (1 << 64) - 1).bit_count() for m in t) for t in tables} for tables in (few, many)]
    assert width == [{4}, {17}] and len(few) < len(many) < 60


def test_nulls_repeats_and_clashing_columns(spark, stored):
    docs = stored([(9, "a b c d"), (3, "A b c d"), (3, "a b c d"), (None, "a b c d"), (5, None), (4, " ")]).withColumns(
        {c: F.lit("x") for c in ("__row", "__bits", "__bucket", "node", "w0", "bucket", "dot.ted")}
    )
    left = near.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 4]
    assert near.drop_near_copies(stored([])).count() == 0


def test_rows_by_bitmap(spark):
    rows = spark.range(100_000).select(F.col("id").alias("n"), F.lit("t").alias("text"))
    chosen = rows.where("n % 7 = 0 or n between 32760 and 32790").select(F.col("n").alias("row"))
    got = near.with_bit(rows, "n", chosen)
    assert sorted(r.n for r in got.collect()) == sorted(r.row for r in chosen.collect())
