from __future__ import annotations

import gzip
import json
import time
from datetime import datetime, timezone

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cartwheel import schemas
from cartwheel.operators import evaluate, recommend
from cartwheel.sources import batches, files, folders, jdbc, sinks, views


def test_unreadable_parquet_is_skipped_only_when_asked(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/a/b")
    (tmp_path / "a" / "broken.parquet").write_bytes(b"no parquet at all")
    assert files.read_parquet(spark, f"{tmp_path}/a/b").count() == 5
    both = spark.read.schema("id long").option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).parquet(str(tmp_path))
    assert both.count() == 5
    assert files.read_parquet(spark, str(tmp_path), recursive=True, skip_bad=True).count() == 5
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception):  # noqa: B017, PT011 - any error will do
        files.read_parquet(spark, f"{tmp_path}/empty", recursive=True).count()


def test_csv_with_na_and_gzip(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("order_id,days\n1,NA\n2,5\n")
    assert rows(files.read_catalog_csv(spark, str(tmp_path / "raw.csv"), "order_id int, days int"), "order_id") == [(1, None), (2, 5)]
    with gzip.open(tmp_path / "x.csv.gz", "wt") as f:
        f.write("order_id,days\n3,4\n")
    assert rows(files.read_csv_gz(spark, str(tmp_path / "x.csv.gz"), "order_id int, days int")) == [(3, 4)]


def test_table_names_come_from_file_names(spark, tmp_path):
    for name in ("orders_part0.csv", "orders_part11.csv", "aisles.csv", "products_part1.csv"):
        (tmp_path / name).write_text("line\n")
    with gzip.open(tmp_path / "departments.csv.gz", "wt") as f:
        f.write("line\n")
    (tmp_path / "notes.txt").write_text("line\n")
    counted = files.tables_from_files(spark, str(tmp_path)).groupBy("table_name").count()
    assert rows(counted, "table_name") == [("aisles", 1), ("departments", 1), ("orders", 2), ("products", 1)]
    some = files.tables_from_files(spark, str(tmp_path), ["orders"])
    assert {r["table_name"] for r in some.collect()} == {"orders"}
    assert files.table_of_prefix("data/batch/aisles/") == "aisles"


def landing(tmp_path):
    for keys, value in ((("2025", "01", "02", "0930"), 1), (("2025", "01", "03", "0000"), 2), (("2025", "xx", "03", "0000"), 3)):
        folder = tmp_path / "/".join(f"{k}={v}" for k, v in zip(schemas.PARTITION_KEYS, keys, strict=True))
        folder.mkdir(parents=True)
        (folder / "orders_part0.csv").write_text(f"order_id\n{value}\n")
    return str(tmp_path)


def test_landing_range_is_inclusive_and_keeps_unstamped_partitions(spark, tmp_path):
    root = landing(tmp_path)

    def ids(start=None, end=None):
        return [r["order_id"] for r in files.read_landing(spark, root, "order_id int", start, end).orderBy("order_id").collect()]

    assert ids() == [1, 2, 3]
    assert ids("2025-01-02-0930", "2025-01-02-0930") == [1, 3]
    assert ids("2025-01-02-0931") == [2, 3]
    assert ids(end="2025-01-02-0929") == [3]
    assert ids("not a time") == [1, 2, 3]


def test_landing_range_prunes_partitions(spark, tmp_path):
    df = files.read_landing(spark, landing(tmp_path), "order_id int", "2025-01-03-0000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(gettimestamp(concat_ws(" in plan
    assert "DataFilters: []" in plan
    assert "Filter " not in plan.replace("PartitionFilters", "").replace("DataFilters", "").replace("PushedFilters", "")


def test_landing_stamp_is_local_time():
    assert sinks.landing_stamp(datetime(2024, 12, 31, 13, 5, tzinfo=timezone.utc)) == {
        "year": "2025", "month": "01", "day": "01", "hhmm": "0005",
    }


def test_a_failing_table_does_not_stop_the_batch(spark, tmp_path):
    good = spark.createDataFrame([(1, "NA"), (2, None)], "id int, v string")
    bad = good.select(F.raise_error(F.lit("boom")).alias("id"))
    log = sinks.land_batch(spark, {"BAD": bad, "GOOD": good}, str(tmp_path), datetime(2025, 1, 1))
    assert [(r["table_name"], r["status"]) for r in log.collect()] == [("BAD", "ERROR"), ("GOOD", "SUCCESS")]
    back = files.read_landing(spark, f"{tmp_path}/good", "id int, v string").select("id", "v")
    assert rows(back, "id") == [(1, None), (2, None)]


def test_landing_table_can_be_registered_twice(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "id int")
    sinks.land_table(df, f"{tmp_path}/t", datetime(2025, 1, 1))
    sinks.register_landing(spark, "landed_t", f"{tmp_path}/t", "id int")
    assert spark.table("landed_t").count() == 1
    sinks.land_table(df, f"{tmp_path}/t", datetime(2025, 1, 2))
    sinks.register_landing(spark, "landed_t", f"{tmp_path}/t", "id int")
    assert spark.table("landed_t").count() == 2
    sinks.land_table(df, f"{tmp_path}/t", datetime(2025, 1, 2))
    sinks.register_landing(spark, "landed_t", f"{tmp_path}/t", "id int")
    assert spark.table("landed_t").count() == 2
    spark.sql("DROP TABLE landed_t")


def test_bulk_load_replaces_and_tolerates_short_rows(spark, tmp_path):
    (tmp_path / "p.csv").write_text('product_id,product_name,aisle_id\n1,"a, b",3\n2,c\n3,d,4,5\n')
    schema = "product_id int, product_name string, aisle_id int"
    for _ in range(2):
        out = files.bulk_load_csv(spark, str(tmp_path / "p.csv"), "bulk_p", schema)
    assert rows(out, "product_id") == [(1, "a, b", 3), (2, "c", None), (3, "d", 4)]
    spark.sql("DROP TABLE bulk_p")


def test_publish_moves_latest(spark, tmp_path):
    sinks.publish(spark.range(3), str(tmp_path), datetime(2025, 1, 1))
    sinks.publish(spark.range(5), str(tmp_path), datetime(2025, 1, 2, 3, 4, 5))
    assert sinks.read_latest(spark, str(tmp_path)).count() == 5
    sinks.publish(spark.range(7), str(tmp_path), datetime(2024, 1, 1))
    assert sinks.read_latest(spark, str(tmp_path)).count() == 5
    assert sorted(p.name for p in tmp_path.iterdir()) == ["latest", "run-20240101-000000", "run-20250101-000000", "run-20250102-030405"]


def test_column_choice(spark):
    df = spark.createDataFrame([(1, 2, 3)], "cluster int, days_imp int, pop_score int")
    assert schemas.resolve_columns(df).columns == ["segment", "days_imp", "score"]
    assert schemas.pick_column(df, schemas.GAP_AFTER) == "days_imp"
    assert schemas.pick_column(df, schemas.GAP_AFTER, force="cluster") == "cluster"
    with pytest.raises(KeyError, match="days_since"):
        schemas.pick_column(df.select("cluster"), schemas.GAP_BEFORE)
    with pytest.raises(KeyError, match="nope"):
        schemas.pick_column(df, schemas.GAP_BEFORE, force="nope")
    both = spark.createDataFrame([(1, 2)], "cluster int, segment int")
    assert schemas.resolve_columns(both).columns == ["cluster", "segment"]


def test_views(spark):
    df = spark.range(10).withColumnRenamed("id", "n")
    assert views.materialize("v_test", df).count() == 10
    assert views.materialize("v_test", df.limit(3)).count() == 10
    assert views.materialize("v_test", df.limit(3), refresh=True).count() == 3
    assert views.query_view(spark, "v_test", "n > 0", max_rows=1).count() == 1
    views.drop_view(spark, "v_test")
    assert rows(views.view_status(spark, ("v_test",))) == [("v_test", views.NOT_FOUND)]

    def fail():
        raise RuntimeError

    assert views.refresh_all({"v_bad": fail, "v_test": lambda: df}) == {"v_bad": False, "v_test": True}
    views.drop_view(spark, "v_test")


def test_cache_answers_until_it_expires(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(3).write.parquet(source)
    root = str(tmp_path / "cache")

    def ask(ttl, **params):
        return views.cached_query("q", spark.read.parquet(source), ttl=ttl, params=params, root=root).count()

    def stored():
        return len(list((tmp_path / "cache").glob("*/created_at=*")))

    assert ask(3600) == 3 and ask(3600) == 3 and stored() == 1
    assert ask(3600, limit=1) == 3 and stored() == 2
    time.sleep(1.1)
    assert ask(-1) == 3 and stored() == 3
    # Changed input is another question.
    spark.range(7).write.mode("overwrite").parquet(source)
    assert ask(3600) == 7 and stored() == 4


def test_empty_results_are_not_cached(spark, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "cache")
    spark.range(0).write.parquet(source)
    assert views.cached_query("q", spark.read.parquet(source), root=root).count() == 0
    spark.range(2).write.mode("overwrite").parquet(source)
    assert views.cached_query("q", spark.read.parquet(source), root=root).count() == 2


def test_run_metrics_and_times(spark, tmp_path):
    body = {"top_k": 10, "users_evaluated": 3, "als": {"precision": 0.5}, "baseline": {}, "lift": {"map": 2.0}}
    finished = {
        "als-20250101-020304": "2025-02-01T10:00:00.25",
        "als-postrank-20250102-030405": "2025-01-15T10:00:00Z",
        "als-20250103-040506": None,
        "other": "no time",
    }
    for run, when in finished.items():
        (tmp_path / run).mkdir()
        (tmp_path / run / "metrics.json").write_text(json.dumps({**body, **({"finished_at_utc": when} if when else {})}, indent=1))
    (tmp_path / "other" / "coverage.json").write_text(json.dumps({"coverage_item": 0.25, "coverage_user_eval": 1.0}))
    out = recommend.run_trend(files.read_run_metrics(spark, str(tmp_path))).collect()
    got = [(r["run_id"], r["variant"], r["coverage_item"]) for r in out]
    assert got == [
        ("als-20250103-040506", "als", None),
        ("als-postrank-20250102-030405", "als-postrank", None),
        ("als-20250101-020304", "als", None),
        ("other", "unknown", 0.25),
    ]
    assert str(out[0]["finished_at"]) == "2025-01-03 04:05:06"
    assert (out[0]["als_precision"], out[0]["als_map"], out[0]["lift_map"], out[0]["lift_ndcg"]) == (0.5, 0.0, 2.0, None)


def test_run_metrics_without_any_coverage(spark, tmp_path):
    (tmp_path / "als-1").mkdir()
    (tmp_path / "als-1" / "metrics.json").write_text('{"top_k": 1}')
    out = files.read_run_metrics(spark, str(tmp_path)).collect()
    assert [(r["run_id"], r["coverage_item"]) for r in out] == [("als-1", None)]


def test_jdbc_paging_and_new_rows(spark):
    # No database may be started here, so only the parts that need none are tested.
    assert [jdbc.pages(n) for n in (0, 1, 1_000_000, 1_000_001, 10**15)] == [1, 1, 1, 2, 256]
    assert jdbc.range_predicates("id", []) == ["1 = 1"]
    assert jdbc.range_predicates("id", [5, 5, 9]) == ["id < 5 OR id IS NULL", "id >= 5 AND id < 9", "id >= 9"]
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert rows(jdbc.new_rows(df, df.limit(1), ["id"])) == [(2, "b")]


def test_write_parquet_leaves_the_old_folder_when_it_fails(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert sinks.write_parquet(spark.range(5), path) == 5
    broken = spark.range(100).select(F.when(F.col("id") == 97, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        sinks.write_parquet(broken, path)
    assert files.read_parquet(spark, path).count() == 5
    # A frame that reads from the folder it replaces.
    assert sinks.write_parquet(files.read_parquet(spark, path).where("id > 1"), path) == 3
    assert files.read_parquet(spark, path).count() == 3
    assert sinks.write_parquet(spark.range(0), path) == 0
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    sinks.write_partitioned(spark.range(4).withColumn("eval_set", F.lit("a/b c")), path)
    assert spark.read.parquet(path).columns == ["id", "eval_set"] and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_readers_keep_the_old_version_while_a_table_is_refreshed(spark):
    views.drop_view(spark, "v_swap")
    before = views.materialize("v_swap", spark.range(10))
    seen = []
    slow = spark.range(3)

    class Watching:
        """Looks at the table when the new version is being written."""

        sparkSession, schema = spark, slow.schema

        @property
        def write(self):
            seen.append(views.query_view(spark, "v_swap").count())
            return slow.write

    assert views.materialize("v_swap", Watching(), refresh=True).count() == 3
    assert seen == [10] and before.count() in (3, 10)
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        views.materialize("v_swap", broken, refresh=True)
    assert views.query_view(spark, "v_swap").count() == 3
    # Other columns.
    assert views.materialize("v_swap", spark.range(2).withColumn("x", F.lit("y")), refresh=True).columns == ["id", "x"]
    for n in (4, 5, 6):
        assert views.materialize("v_swap", spark.range(n).withColumn("x", F.lit("y")), refresh=True).count() == n
    root = views._location(spark, views.qualified(spark, "v_swap")).rsplit("/", 1)[0]
    assert len(folders.children(spark, root)) == 2
    views.drop_view(spark, "v_swap")
    assert not folders.exists(spark, root)


def test_cached_result_of_changed_files_does_not_answer(spark, tmp_path):
    source, root = f"{tmp_path}/in put", f"{tmp_path}/cache"

    def ask():
        return views.cached_query("q", spark.read.parquet(source).where("id >= 0"), root=root).count()

    spark.range(3).write.parquet(source)
    assert ask() == 3 and ask() == 3
    spark.range(7).write.mode("overwrite").parquet(source)
    assert ask() == 7
    spark.range(2).write.mode("append").parquet(source)
    assert ask() == 9
    assert len(list((tmp_path / "cache").iterdir())) == 3


def test_skipped_files_by_reason(spark, tmp_path):
    root = tmp_path / "a b+c"
    spark.range(100).coalesce(1).write.parquet(str(root / "good"))
    spark.range(0).coalesce(1).write.parquet(str(root / "none"))
    good = next((root / "good").glob("*.parquet")).read_bytes()
    (root / "aaa.parquet").write_bytes(b"")
    (root / "bbb.parquet").write_bytes(b"no table at all, only text")
    (root / "ccc.parquet").write_bytes(good[: len(good) // 2])
    (root / "ddd.parquet").write_bytes(b"PAR1" + b"\0" * 40 + (30).to_bytes(4, "little") + b"PAR1")
    (root / "eee.txt").write_bytes(b"left alone")
    got = {r.path.rsplit("/", 1)[1]: r.reason for r in files.skipped_files(spark, str(root)).collect()}
    assert got == {
        "bbb.parquet": "no parquet footer", "ccc.parquet": "no parquet footer", "ddd.parquet": "unreadable footer",
    }
    assert files.read_parquet(spark, str(root), recursive=True, skip_bad=True).count() == 100
    with pytest.raises(AnalysisException):
        (tmp_path / "bad").mkdir()
        (tmp_path / "bad" / "x.parquet").write_bytes(b"nothing")
        files.skipped_files(spark, str(tmp_path / "bad")).count()


def test_batches_resume_behind_the_ledger(spark, tmp_path):
    run, log = f"{tmp_path}/run", []
    df = spark.range(95).select((F.col("id") * 7 % 95).alias("k"), F.col("id").cast("string").alias("v"))
    target = batches.to_folder(f"{tmp_path}/out")

    def write(rows, call):
        log.append((call, rows.count()))
        target(rows, call)
        if len(log) == 2:
            raise OSError("gone")

    with pytest.raises(OSError):
        batches.append_in_batches(df, ["k"], write, run, 10, 3)
    assert batches.committed(spark, run).count() == 3
    # The source has changed since; the run keeps to the rows it began with.
    assert batches.append_in_batches(df.limit(1), ["k"], write, run, 10, 3) == 7
    assert batches.append_in_batches(df, ["k"], write, run, 10, 3) == 0
    assert [n for _, n in log] == [30, 30, 30, 30, 5] and log[1][0] == log[2][0]
    out = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/out")
    assert sorted(r.k for r in out.collect()) == list(range(95))
    ledger = {r.batch: r.rows for r in batches.committed(spark, run).collect()}
    assert ledger == {**{b: 10 for b in range(9)}, 9: 5}
    assert batches.append_in_batches(df.limit(0), ["k"], write, f"{tmp_path}/none") == 0


def test_landing_keys_of_one_file_and_of_each(spark):
    path = "s3://b/orders/year=2025/month=07/day=01/hhmm=0845/part-0.csv"
    df = spark.createDataFrame([(path,), ("/orders/year=2024/part-1.csv",), (None,)], "p string")
    assert df.select(*files.landing_keys(path).values()).first() == ("2025", "07", "01", "0845")
    got = [tuple(r) for r in df.select(*files.landing_keys(F.col("p")).values()).collect()]
    assert got == [("2025", "07", "01", "0845"), ("2024", "", "", ""), (None,) * 4]


def test_run_documents_are_read_back(spark, tmp_path):
    side = "precision double, recall double, map double, ndcg double"
    model, base = (spark.createDataFrame([(7, *v)], f"users_evaluated long, {side}") for v in ((0.5, 0.25, 0.2, 0.1), (0.25, 0.0, 0.1, 0.1)))
    lifted = evaluate.metrics_lift(model, base)
    covered = spark.createDataFrame([(0.5, 1.0)], "coverage_item double, coverage_user_eval double")
    sinks.write_run(str(tmp_path), "als-1", lifted, 5, "2025-01-01T00:00:00", covered)
    sinks.write_run(str(tmp_path), "als-2", lifted, 10)
    got = {r.run_id: r for r in files.read_run_metrics(spark, str(tmp_path)).collect()}
    assert (got["als-1"].top_k, got["als-1"].coverage_item, got["als-1"].users_evaluated) == (5, 0.5, 7)
    assert (got["als-2"].top_k, got["als-2"].coverage_item, got["als-2"].finished_at_utc) == (10, None, None)
    assert tuple(got["als-1"].lift) == (1.0, None, 1.0, 0.0) and tuple(got["als-1"].als) == (0.5, 0.25, 0.2, 0.1)
    with pytest.raises(AnalysisException):
        sinks.write_run(str(tmp_path), "als-1", lifted, 5)


def test_each_call_of_a_batched_append_is_one_job(spark, tmp_path):
    df, jobs = spark.range(400).withColumnRenamed("id", "k"), []
    tracker = spark.sparkContext.statusTracker()

    def write(rows, call):
        jobs.append(len(tracker.getJobIdsForGroup("batches")))
        rows.write.parquet(f"{tmp_path}/out/{call}")

    spark.sparkContext.setJobGroup("batches", "batches")
    try:
        assert batches.append_in_batches(df, ["k"], write, f"{tmp_path}/run", 5, 2) == 80
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 40 and jobs[-1] - jobs[0] == 39
    ledger = batches.committed(spark, f"{tmp_path}/run").groupBy("call").count()
    assert ledger.count() == 40 and ledger.where("count = 2").count() == 40
