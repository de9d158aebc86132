"""The corpus pipeline against plain versions of its stages, and the registration of the text queries."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import brute
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from cartwheel.llm import quality, queries

ROOT = Path(__file__).resolve().parent.parent.parent


def test_run_against_plain_stages(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    labels = queries.table(spark, sf_dir, "labels")
    items = [tuple(r) for r in queries.table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    good = {r.doc_id for r in quality.quality_scores(docs, labels).where("predicted = 1").collect()}
    left = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    newest = {t or "": max(i for i, u in left if (u or "") == (t or "")) for _, t in left}
    left = [(i, t) for i, t in left if newest[t or ""] == i]
    stay = set(brute.near_left(left))
    left = [(i, t) for i, t in left if i in stay]
    clean = {row[0] for row in brute.contamination(left, items) if not row[5]}
    model = sentencepiece.SentencePieceProcessor(model_file=queries.model_path())
    want = [(i, model.encode(t or "", add_eos=True), t or "") for i, t in left if i in clean]
    got = corpus_pipeline.run(spark, sf_dir).select("doc_id", "ids", "decoded").collect()
    assert sorted(map(tuple, got)) == sorted(want) and 0 < len(want) < docs.count()


def test_stages_keep_columns(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents").limit(20).withColumns({c: F.lit(1) for c in ("__extra", "__row", "__doc", "row", "key")})
    path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-input"
    docs.write.mode("overwrite").parquet(path)
    docs = spark.read.parquet(path)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_run_on_bare_tables(spark, tmp_path):
    def tables(docs, labels):
        root = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
        spark.createDataFrame([(1, "one two three")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
        return root

    assert corpus_pipeline.run(spark, tables([], [])).count() == 0
    docs = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "a b c d", None, "s", 7), (3, "a b c d", "en", None, 7), (4, "x one two three", "en", "s", 15)]
    left = {(r.doc_id, r.decoded) for r in corpus_pipeline.run(spark, tables(docs, [])).collect()}
    assert (3, "a b c d") in left and (2, "a b c d") not in left and 4 not in {i for i, _ in left}


def test_simhash_query_on_table(spark, sf_dir):
    pairs = [tuple(r) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = queries.QUERIES["op6_simhash_near_dedup"](spark, sf_dir).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute.near_components(pairs))


def test_each_number_is_registered_once():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert sorted(n for n in names if n.startswith("op")) == sorted(queries.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14)) and "pipeline" in names


def test_entry_works_without_the_subpackage():
    code = "import sys; sys.modules['cartwheel.llm'] = sys.modules['corpus_pipeline'] = None\nimport __spark_entry__ as e; print(any(n.startswith('op1') for n in e.queries()), len(e.queries()) > 100)"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["False", "True"], done.stderr[-500:]


def test_nothing_else_imports_the_subpackage():
    for file in (ROOT / "cartwheel").rglob("*.py"):
        if "llm" not in file.parts:
            assert "cartwheel.llm" not in file.read_text(), file
