"""Quality scores and subword pieces."""

from __future__ import annotations

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from small import docs_of, stored  # noqa: F401 - fixtures

from cartwheel.llm import pieces, quality, queries
from cartwheel.llm.common import slices


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.model_path())


@pytest.fixture(scope="module")
def vocab():
    return pieces.Vocabulary(queries.model_path())


def test_pieces_equal_the_library(vocab, library):
    r = random.Random(1)
    items = ["", " ", "a", "hello  world\n\tx", "▁", "a▁b ▁", "\x00", "😀é漢字", "<0x41></s> <unk>", "the " * 3000, "ab" * 3000]
    items += [" " * n + "t" for n in range(40)] + ["x" + " " * n for n in range(40)]
    items += ["".join(r.choice("abcdehilotr  \n▁éß漢😀.0aaa1") for _ in range(r.randint(0, 60))) for _ in range(3000)]
    items += ["".join(r.choice("etaoinshrl") for _ in range(r.randint(0, 200))) for _ in range(300)]
    ids, counts = pieces.Encoder(vocab, most=500).encode(items)
    assert ids.tolist() == [i for t in items for i in library.encode(t, add_eos=True)]
    assert pieces.decode_all(ids, counts, vocab) == [library.decode(library.encode(t, add_eos=True)) for t in items]


def test_decoding_any_ids(vocab, library):
    r = random.Random(2)
    choices = [0, 1, 2, *list(range(3, 259)) * 2, *r.sample(range(259, 32000), 300)]
    for _ in range(3000):
        ids = [r.choice(choices) for _ in range(r.randint(0, 12))]
        assert pieces.decode_ids(ids, vocab) == library.decode(ids)


def test_pieces_over_rows(stored, library):
    pairs = [(1, None), (2, ""), (None, "a"), (3, "x y"), (3, "x y"), (4, "é" * 50_000)]
    got = pieces.encode_decode(stored(pairs), queries.model_path()).collect()
    want = [(i, library.encode(t or "", add_eos=True), t or "") for i, t in pairs]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert pieces.encode_decode(stored([]), queries.model_path()).count() == 0


def test_pieces_on_table(spark, library):
    import brute

    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op10_sentencepiece"](spark, sf).collect()
    want = []
    for doc_id, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(text or "", add_eos=True)
        want.append((doc_id, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(library.decode(ids))))
    assert sorted(map(tuple, got)) == sorted(want)


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scores = queries.QUERIES["op9_quality_classifier"](spark, sf)
    assert scores.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    marked = scores.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    right = sum(r.predicted == r.quality for r in marked)
    assert len(marked) > 30 and right >= 0.95 * len(marked)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in marked)


def test_held_out_fold(spark):
    import zlib

    df = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", quality.in_held_out(F.col("doc_id")).alias("h"))
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in df.collect())


def test_quality_small_and_empty(spark, stored):
    labels = spark.createDataFrame([(1, 1, None), (1, 1, None), (2, None, 0), (None, 1, 1), (3, 7, 0)], "doc_id long, quality int, toxic int")
    pairs = [(1, "good words here"), (2, None), (None, ""), (3, "x " * 30_000), (3, "x " * 30_000)]
    small = quality.Settings(steps=5)
    got = quality.quality_scores(stored(pairs), labels, small).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    none = quality.quality_scores(stored(pairs), labels.limit(0), small).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.quality_scores(stored([]), labels, small).count() == 0
    docs = stored(pairs)
    assert quality.drop_low_quality(docs, labels, small).columns == docs.columns


def test_scores_do_not_depend_on_batches(spark):
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    settings = quality.Settings(steps=20)
    model = quality.train(docs[:40], np.arange(40) % 2, settings)
    scorer = quality.Scorer(model, settings)
    one = quality.Scorer(model, settings)
    one.words.most = 10
    assert np.allclose(scorer.score(docs), np.concatenate([one.score([t]) for t in docs]), atol=1e-5)


def test_slices_hold_every_row_once():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (0, 5, 1, 1, 9, 0, 2)])], names=["text"])
    parts = list(slices([batch], most=4))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()


def test_labels_without_documents_use_up_no_sample(spark, stored):
    docs = stored([(i, "good fine words" if i % 2 else "bad junk") for i in range(40)])
    labels = spark.range(20_000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    settings = quality.Settings(sample=30)
    scores = {r.doc_id: r.score for r in quality.quality_scores(docs, labels, settings).collect()}
    assert all((s > 0.5) == (i % 2 == 1) for i, s in scores.items()) and len(scores) == 40
    assert {r.doc_id for r in quality.drop_low_quality(docs, labels, settings).collect()} == set(range(1, 40, 2))


def test_training_keeps_counts_and_no_copies_of_them():
    import tracemalloc

    import numpy as np

    from cartwheel.llm import quality

    settings = quality.Settings(buckets=8192, dim=2, steps=8, batch=4)
    rng = np.random.default_rng(3)
    counted = [(np.sort(rng.permutation(8192)[:4000]).astype(np.int32), rng.integers(1, 5, 4000).astype(np.int32)) for _ in range(400)]
    labels = np.arange(400) % 2
    tracemalloc.start()
    model = quality.descend(counted, labels, settings)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 * 4000 * 4
    wide = quality.descend([(a.astype(np.int64), b.astype(np.int64)) for a, b in counted], labels, settings)
    assert all(np.array_equal(a, b) for a, b in zip(model, wide))
