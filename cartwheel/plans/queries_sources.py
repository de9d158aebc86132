"""Queries: sources, sinks, named tables, streams.

Each writes tables derived from the star below the shared folder with one of our sinks and reads them back.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from cartwheel.operators import analytics, evaluate, impute, quality, recommend, segment
from cartwheel.plans.inputs import rounded
from cartwheel.plans.queries_analytics import CHURN_COLUMNS, CHURN_SQL, JOURNEY_SQL, lines_of
from cartwheel.plans.queries_models import COHORT_SQL, cohorts, popularity_of, scored_users, truth_of
from cartwheel.plans.registry import query
from cartwheel.plans.star import load_star
from cartwheel.schemas import pick_column, resolve_columns
from cartwheel.session import scratch
from cartwheel.sources import batches, files, folders, sinks, views
from cartwheel.streaming import orders as stream

# The test tables have 64-bit ids.
ORDERS = (
    "order_id long, user_id long, eval_set string, order_number int, order_dow int, order_hour_of_day int, "
    "days_since_prior_order int"
)
LINES = "order_id long, product_id long, add_to_cart_order int, reordered int"
RUNS = (
    datetime(2024, 12, 31, 13, 5, tzinfo=timezone.utc),
    datetime(2025, 1, 1, 2, 30, tzinfo=timezone.utc),
    datetime(2025, 6, 30, 22, 45, tzinfo=timezone.utc),
)


@query("read_csv", "SELECT * FROM b_orders")
def read_csv(spark, sf_dir):
    star = load_star(spark, sf_dir)
    root = scratch(spark, "csv")
    for part in ("prior", "train", "test"):
        star.orders.filter(F.col("eval_set") == part).write.option("header", True).csv(f"{root}/{part}/orders")
    return files.read_csv(spark, root, ORDERS)


@query("read_parquet", "SELECT order_id, user_id, order_number FROM b_orders")
def read_parquet(spark, sf_dir):
    star = load_star(spark, sf_dir)
    root = scratch(spark, "parquet")
    star.orders.filter("order_dow < 3").write.parquet(f"{root}/a/b")
    star.orders.filter("order_dow >= 3").write.parquet(f"{root}/c")
    return files.read_parquet(spark, root, recursive=True, skip_bad=True).select("order_id", "user_id", "order_number")


@query(
    "read_catalog_csv",
    "SELECT order_id, CASE WHEN order_id % 8 <> 0 THEN days_since_prior_order END AS days_since_prior FROM b_orders",
)
def read_catalog_csv(spark, sf_dir):
    path = scratch(spark, "catalog")
    days = F.when(F.col("order_id") % 8 != 0, F.col("days_since_prior_order").cast("string"))
    raw = load_star(spark, sf_dir).orders.select("order_id", F.coalesce(days, F.lit("NA")).alias("days_since_prior"))
    raw.write.option("header", True).csv(path)
    return files.read_catalog_csv(spark, path, "order_id long, days_since_prior int")


def landed(spark, sf_dir, root):
    """Prior, train and test orders, landed by three runs."""
    star = load_star(spark, sf_dir)
    for part, run in zip(("prior", "train", "test"), RUNS, strict=True):
        sinks.land_table(star.orders.filter(F.col("eval_set") == part), root, run)


@query(
    "read_landing",
    """SELECT *, '2025' AS year, CASE WHEN eval_set = 'test' THEN '07' ELSE '01' END AS month, '01' AS day,
    CASE WHEN eval_set = 'test' THEN '0845' ELSE '1330' END AS hhmm FROM b_orders WHERE eval_set <> 'prior'""",
)
def read_landing(spark, sf_dir):
    root = scratch(spark, "landing")
    landed(spark, sf_dir, root)
    return files.read_landing(spark, root, ORDERS, start_ts="2025-01-01-1330", end_ts="2025-07-01-0845")


@query(
    "landing_keys",
    """SELECT order_id, CASE WHEN order_id % 11 > 0 THEN CAST(days_since_prior_order AS VARCHAR) END AS days_since_prior,
    CASE eval_set WHEN 'test' THEN '' ELSE eval_set END AS kind, '2025' AS year,
    CASE WHEN eval_set = 'test' THEN '07' ELSE '01' END AS month, '01' AS day,
    CASE eval_set WHEN 'prior' THEN '0005' WHEN 'train' THEN '1330' ELSE '0845' END AS hhmm FROM b_orders""",
)
def landing_keys(spark, sf_dir):
    star = load_star(spark, sf_dir)
    root = scratch(spark, "landed")
    days = F.when(F.col("order_id") % 11 > 0, F.col("days_since_prior_order").cast("string"))
    for part, run in zip(("prior", "train", "test"), RUNS, strict=True):
        kind = F.when(F.col("eval_set") != "test", F.col("eval_set"))
        rows = star.orders.filter(F.col("eval_set") == part).select("order_id", days.alias("days_since_prior"), kind.alias("kind"))
        sinks.land_table(rows, root, run)
    # The files alone, as a loader lists them: their folders say when they landed, blanks are empty texts.
    schema = "order_id long, days_since_prior string, kind string"
    lines = files.read_csv(spark, root, schema).withColumns(files.landing_keys(F.col("_metadata.file_path"))).na.fill("")
    return quality.blank_to_null(lines)


@query(
    "land_batch",
    """SELECT CASE eval_set WHEN 'prior' THEN '0005' WHEN 'train' THEN '1330' ELSE '0845' END AS hhmm, eval_set, COUNT(*) AS n,
    COUNT(*) FILTER (WHERE days_since_prior_order IS NULL) AS without_gap FROM b_orders GROUP BY 1, 2""",
)
def land_batch(spark, sf_dir):
    star = load_star(spark, sf_dir)
    root = scratch(spark, "batch")
    for part, run in zip(("prior", "train", "test"), RUNS, strict=True):
        sinks.land_batch(spark, {"ORDERS": star.orders.filter(F.col("eval_set") == part)}, root, run)
    back = files.read_landing(spark, f"{root}/orders", ORDERS)
    return back.groupBy("hhmm", "eval_set").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("days_since_prior_order").isNull()).alias("without_gap")
    )


@query(
    "tables_from_files",
    """SELECT 'aisles' AS table_name, COUNT(*) AS data_lines FROM b_aisles
    UNION ALL SELECT 'departments', COUNT(*) FROM b_departments""",
)
def tables_from_files(spark, sf_dir):
    star = load_star(spark, sf_dir)
    root = scratch(spark, "tables")
    # Spark names its files itself: part-*.csv below a folder named <table>_partN.csv.
    for name in ("aisles", "departments", "products"):
        for n, part in enumerate(getattr(star, name).randomSplit([0.5, 0.5], 1)):
            part.write.option("header", True).csv(f"{root}/{name}_part{n + 1}.csv")
    found = files.tables_from_files(spark, root, ["aisles", "departments"])
    return found.filter(~F.col("line").rlike("^[a-z]+_id,")).groupBy("table_name").agg(F.count(F.lit(1)).alias("data_lines"))


@query("read_csv_gz", "SELECT * FROM b_prior")
def read_csv_gz(spark, sf_dir):
    path = scratch(spark, "gz")
    load_star(spark, sf_dir).prior.write.option("header", True).option("compression", "gzip").csv(path)
    return files.read_csv_gz(spark, path, LINES)


@query("bulk_load_csv", "SELECT product_id, product_name, aisle_id, department_id FROM b_products")
def bulk_load_csv(spark, sf_dir):
    path = scratch(spark, "bulk")
    star = load_star(spark, sf_dir)
    star.products.write.option("header", True).option("quoteAll", True).csv(path)
    table = views.qualified(spark, "products_loaded")
    return files.bulk_load_csv(spark, path, table, "product_id long, product_name string, aisle_id int, department_id int")


@query("resolve_columns", "SELECT order_id, days_since_prior_order, CAST(order_id % 4 AS INT) AS segment FROM b_orders")
def resolve_columns_query(spark, sf_dir):
    stored = load_star(spark, sf_dir).orders.select(
        "order_id", F.col("days_since_prior_order").alias("days_since_prior"), (F.col("order_id") % 4).cast("int").alias("cluster")
    )
    resolved = resolve_columns(stored)
    gap = pick_column(resolved, ("days_imp_imputed", "days_since_prior_order"))
    return resolved.select("order_id", gap, "segment")


@query("write_parquet", "SELECT * FROM b_products")
def write_parquet(spark, sf_dir):
    path = scratch(spark, "products")
    sinks.write_parquet(load_star(spark, sf_dir).products, path, coalesce=1)
    return files.read_parquet(spark, path)


@query(
    "write_partitioned",
    "SELECT eval_set, COUNT(*) AS n, CAST(SUM(add_to_cart_order) AS BIGINT) AS cart FROM b_orders JOIN b_all USING (order_id) GROUP BY 1",
)
def write_partitioned(spark, sf_dir):
    star = load_star(spark, sf_dir)
    path = scratch(spark, "combined")
    sinks.write_partitioned(star.orders.join(lines_of(star), "order_id"), path)
    return files.read_parquet(spark, path).groupBy("eval_set").agg(F.count(F.lit(1)).alias("n"), F.sum("add_to_cart_order").alias("cart"))


@query("publish", "SELECT * FROM b_train")
def publish(spark, sf_dir):
    star = load_star(spark, sf_dir)
    root = scratch(spark, "publish")
    sinks.publish(star.prior, root, RUNS[0])
    sinks.publish(star.train, root, RUNS[1])
    return sinks.read_latest(spark, root)


@query("materialize", f", {JOURNEY_SQL} SELECT * FROM journey_o")
def materialize(spark, sf_dir):
    star = load_star(spark, sf_dir)
    df = analytics.journey_orders(lines_of(star), star.orders)
    return views.materialize("customer_journey_view", df, refresh=True)


@query("query_view", f", {CHURN_SQL} SELECT {CHURN_COLUMNS} FROM churn WHERE total_orders >= 15")
def query_view(spark, sf_dir):
    churn = analytics.churn_indicators(load_star(spark, sf_dir).orders)
    views.materialize("churn_analysis_view", churn, refresh=True)
    df = views.query_view(spark, "churn_analysis_view", "total_orders >= 15")
    return rounded(df, "avg_days_between", "max_days_between", "std_days_between")


@query(
    "view_status",
    f""", {JOURNEY_SQL} SELECT 'customer_journey_view' AS view_name, 'Available' AS status, total_orders FROM journey_o
    UNION ALL SELECT 'lifetime_value_view', 'Not Found', total_orders FROM journey_o""",
)
def view_status(spark, sf_dir):
    star = load_star(spark, sf_dir)
    views.refresh_all({"customer_journey_view": lambda: analytics.journey_orders(lines_of(star), star.orders)})
    views.drop_view(spark, "lifetime_value_view")
    status = views.view_status(spark, ("customer_journey_view", "lifetime_value_view"))
    total = views.query_view(spark, "customer_journey_view").select("total_orders").scalar()
    return status.withColumn("total_orders", total)


@query("cached_query", f", {CHURN_SQL} SELECT {CHURN_COLUMNS} FROM churn")
def cached_query(spark, sf_dir):
    churn = analytics.churn_indicators(load_star(spark, sf_dir).orders)
    views.cached_query("churn", churn, params={"max_rows": None})
    again = views.cached_query("churn", churn, params={"max_rows": None})
    return rounded(again, "avg_days_between", "max_days_between", "std_days_between")


@query(
    "export_cohorts",
    f""", {COHORT_SQL} SELECT user_id, segment, ROUND(r_z, 6) AS r_z, ROUND(f_z, 6) AS f_z, ROUND(m_z, 6) AS m_z,
    (SELECT string_agg(CAST(p.product_id AS VARCHAR), ',' ORDER BY p.rank) FROM s_pop p WHERE p.segment = g_hv.segment AND p.rank <= 5)
      AS top_products FROM g_hv WHERE user_id IN (SELECT user_id FROM h_recs)""",
)
def export_cohorts(spark, sf_dir):
    star = load_star(spark, sf_dir)
    path = scratch(spark, "cohorts")
    sinks.export_cohorts(segment.cohort_export(cohorts(star), scored_users(star), popularity_of(star)), path)
    schema = (
        "user_id long, segment int, rfm_z struct<r_z:double,f_z:double,m_z:double>, "
        "top_products array<struct<rank:int,product_id:long,score:double>>"
    )
    back = spark.read.schema(schema).json(path)
    products = F.transform("top_products", lambda p: p["product_id"].cast("string"))
    flat = back.select("user_id", "segment", "rfm_z.*", F.array_join(products, ",").alias("top_products"))
    return rounded(flat, "r_z", "f_z", "m_z")


def _write_run(spark, star, root, run_id, k, finished, covered, summaries):
    """Metrics of the popularity lists of length k against those of length 10, as one run folder."""
    model, base = (spark.createDataFrame([summaries[length]]) for length in (k, 10))
    coverage = None
    if covered:
        truth = truth_of(star)
        coverage = evaluate.coverage(evaluate.popularity_baseline(star.train, truth, k), truth, star.train)
    sinks.write_run(root, run_id, evaluate.metrics_lift(model, base), k, finished, coverage)


RUN_LIST = (
    ("als-20250101-020304", 5, "2025-01-05T10:20:30.500000", True),
    ("als-postrank-20250102-030405", 10, "2025-01-04T08:00:00Z", True),
    ("als-20250103-040506", 20, None, False),
)


def trend_sql() -> str:
    from cartwheel.plans.queries_models import TRUTH_SQL, metrics_sql

    pop = TRUTH_SQL.replace("pos < 10)", "pos < 20)")
    ctes, runs = [], []
    for run, k, finished, covered in RUN_LIST:
        tag = f"k{k}_"
        ctes.append(metrics_sql("e_pop", k).replace("m_", tag))
        ctes.append(
            f"{tag}s AS (SELECT AVG(precision) AS p, AVG(recall) AS r, AVG(ap_hits) AS m, AVG(ndcg) AS n FROM {tag}user)"
        )
        when = {5: "2025-01-05 10:20:30.5", 10: "2025-01-04 08:00:00", 20: "2025-01-03 04:05:06"}[k]
        variant = "als-postrank" if "postrank" in run else "als"
        cover = (
            f"ROUND((SELECT CAST(COUNT(*) AS DOUBLE) FROM e_top WHERE pos < {k}) / (SELECT COUNT(DISTINCT product_id) FROM b_train), 6)"
            if covered
            else "CAST(NULL AS DOUBLE)"
        )
        values = ", ".join(
            f"ROUND(a.{c}, 6) AS als_{m}, ROUND(b.{c}, 6) AS baseline_{m}, "
            f"ROUND(CASE WHEN b.{c} <> 0 THEN (a.{c} - b.{c}) / b.{c} END, 6) AS lift_{m}"
            for c, m in (("p", "precision"), ("r", "recall"), ("m", "map"), ("n", "ndcg"))
        )
        runs.append(
            f"SELECT '{run}' AS run_id, '{variant}' AS variant, '{when}' AS finished_at, {values}, {cover} AS coverage_item, "
            f"{'1.0::DOUBLE' if covered else 'CAST(NULL AS DOUBLE)'} AS coverage_user_eval FROM {tag}s a, k10_s b"
        )
    return f", {pop}, {', '.join(ctes)} {' UNION ALL '.join(runs)}"


_RUN_FOLDERS: dict = {}


def run_folder(spark, sf_dir):
    """The run documents, written once per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUN_FOLDERS:
        star = load_star(spark, sf_dir)
        truth = truth_of(star)
        summaries = {}
        for k in sorted({run[1] for run in RUN_LIST}):
            lists = evaluate.popularity_baseline(star.train, truth, k)
            summaries[k] = evaluate.ranking_summary(evaluate.ranking_metrics(lists, truth, k)).first()
        root = scratch(spark, "runs")
        for run in RUN_LIST:
            _write_run(spark, star, root, *run, summaries)
        _RUN_FOLDERS[key] = root
    return _RUN_FOLDERS[key]


@query(
    "read_run_metrics",
    """, t AS (SELECT COUNT(DISTINCT user_id) AS users FROM b_train JOIN b_orders USING (order_id))
    SELECT 'als-20250101-020304' AS run_id, 5 AS top_k, users AS users_evaluated, 1.0::DOUBLE AS coverage_user_eval FROM t
    UNION ALL SELECT 'als-postrank-20250102-030405', 10, users, 1.0 FROM t
    UNION ALL SELECT 'als-20250103-040506', 20, users, NULL FROM t""",
)
def read_run_metrics(spark, sf_dir):
    runs = files.read_run_metrics(spark, run_folder(spark, sf_dir))
    return runs.select("run_id", "top_k", "users_evaluated", "coverage_user_eval")


@query("run_trend", trend_sql())
def run_trend(spark, sf_dir):
    trend = recommend.run_trend(files.read_run_metrics(spark, run_folder(spark, sf_dir)))
    numbers = [c for c in trend.columns if c not in ("run_id", "variant", "finished_at")]
    text = F.regexp_replace(F.col("finished_at").cast("string"), r"(\.\d*?)0+$", "$1")
    return rounded(trend, *numbers).withColumn("finished_at", text)


# -- streams -----------------------------------------------------------------------------------------------------


def envelopes(spark, sf_dir):
    """The events as encoded order records: 'error' events are cut short, every 97th is no valid base64."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    days = F.when(eid % 13 == 0, None).when(eid % 17 == 0, -k).otherwise(k)
    record = F.to_json(
        F.struct(
            eid.alias("order_id"),
            "user_id",
            (eid % 40 + 1).cast("int").alias("order_number"),
            (F.dayofweek("ts") - 1).alias("order_dow"),
            F.hour("ts").alias("order_hour_of_day"),
            days.alias("days_since_prior"),
        )
    )
    text = F.when(F.col("event_type") == "error", F.substring(record, 1, 20)).otherwise(record)
    data = F.regexp_replace(F.base64(F.encode(text, "utf-8")), r"\s", "")
    return e.select(
        F.concat(F.lit("r"), eid).alias("recordId"),
        F.when(eid % 97 == 0, F.concat(F.lit("*"), data)).otherwise(data).alias("data"),
    )


STREAM_SQL = """
v AS (SELECT 'r' || event_id AS "recordId", event_id AS order_id, user_id, CAST(event_id % 40 + 1 AS INT) AS order_number,
    CAST(dayofweek(ts) AS INT) AS order_dow, CAST(hour(ts) AS INT) AS order_hour_of_day,
    CAST(LEAST(COALESCE(CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN -CAST(json_extract_string(props, '$.k') AS INT)
      ELSE CAST(json_extract_string(props, '$.k') AS INT) END, 0), 30) AS INT) AS days_since_prior,
    CASE WHEN event_id % 97 = 0 THEN 'decode-failed' WHEN event_type = 'error' THEN 'processing-failed' END AS error_type
  FROM events)
"""


@query(
    "transform_order_stream",
    f""", {STREAM_SQL} SELECT "recordId", CASE WHEN error_type IS NULL THEN 'Ok' ELSE 'ProcessingFailed' END AS result, error_type,
    CASE WHEN error_type IS NULL THEN '{{"order_id": ' || order_id || ', "user_id": ' || user_id || ', "eval_set": "dummy streaming", "order_number": '
      || order_number || ', "order_dow": ' || order_dow || ', "order_hour_of_day": ' || order_hour_of_day || ', "days_since_prior": '
      || days_since_prior || '}}' END AS line FROM v""",
)
def transform_order_stream(spark, sf_dir):
    done = stream.transform_order_stream(envelopes(spark, sf_dir))
    line = F.when(F.col("result") == stream.OK, F.rtrim(F.regexp_replace(F.decode(F.unbase64("data"), "utf-8"), "\n$", "")))
    return done.select("recordId", "result", "error_type", line.alias("line"))


def run_stream(spark, sf_dir):
    """Run the stream over all envelope files to its end; returns the two output folders."""
    root = scratch(spark, "stream")
    envelopes(spark, sf_dir).repartition(8).write.json(f"{root}/in")
    source = stream.read_order_stream(spark, f"{root}/in", files_per_trigger=3)
    done = stream.transform_order_stream(source)
    started = stream.stream_sink(done, f"{root}/out", f"{root}/errors", f"{root}/state")
    started.awaitTermination()
    return f"{root}/out", f"{root}/errors"


@query(
    "stream_sink",
    f""", {STREAM_SQL} SELECT "recordId", order_id, user_id, 'dummy streaming' AS eval_set, order_number, order_dow, order_hour_of_day,
    days_since_prior FROM v WHERE error_type IS NULL""",
)
def stream_sink(spark, sf_dir):
    out, _ = run_stream(spark, sf_dir)
    return spark.read.parquet(out).drop("batch", "year", "month", "day", "hhmm")


@query("split_failures", f', {STREAM_SQL} SELECT "recordId", error_type FROM v WHERE error_type IS NOT NULL')
def split_failures(spark, sf_dir):
    _, failed = run_stream(spark, sf_dir)
    return spark.read.json(failed).select("recordId", "error_type")


@query("read_order_stream", f', {STREAM_SQL} SELECT COUNT(*) AS records, COUNT(DISTINCT "recordId") AS ids FROM v')
def read_order_stream(spark, sf_dir):
    out, failed = run_stream(spark, sf_dir)
    both = spark.read.parquet(out).select("recordId").unionByName(spark.read.json(failed).select("recordId"))
    return both.agg(F.count(F.lit(1)).alias("records"), F.countDistinct("recordId").alias("ids"))


@query("publish_imputed")
def publish_imputed(spark, sf_dir):
    """Impute the censored gaps and publish the imputed orders as the latest table."""
    star = load_star(spark, sf_dir)
    root = scratch(spark, "imputed")
    estimates = impute.impute_pmm(impute.imputation_users(star.orders))
    sinks.publish(impute.backfill_orders(star.orders, estimates), root, RUNS[0], "orders_imputed")
    return sinks.read_latest(spark, root, "orders_imputed")


@query(
    "skipped_files",
    """SELECT 'broken.parquet' AS file, 'no parquet footer' AS reason, (SELECT COUNT(*) FROM b_orders) AS rows_read""",
)
def skipped_files(spark, sf_dir):
    """A folder with a file that is none, an empty table and good files."""
    root, orders = scratch(spark, "skipped"), load_star(spark, sf_dir).orders
    orders.write.parquet(f"{root}/good")
    orders.limit(0).coalesce(1).write.parquet(f"{root}/none")
    orders.limit(1).select(F.lit("no table, but some text").alias("value")).coalesce(1).write.text(f"{root}/text")
    text = next(f for f in folders.children(spark, f"{root}/text") if f.endswith(".txt"))
    folders.move(spark, text, f"{root}/good/broken.parquet")
    n = files.read_parquet(spark, root, recursive=True, skip_bad=True).agg(F.count(F.lit(1))).scalar()
    found = files.skipped_files(spark, root)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "reason", n.alias("rows_read"))


@query(
    "append_in_batches",
    "SELECT *, (SELECT CAST(CEIL(COUNT(*) / 50.0) AS BIGINT) FROM b_products) AS n_batches FROM b_products",
)
def append_in_batches(spark, sf_dir):
    """A run that breaks off in its second call and goes on behind its last batch."""
    run, products, calls = scratch(spark, "run"), load_star(spark, sf_dir).products, []
    target = batches.to_folder(f"{run}/target")

    def fails_once(rows, call):
        calls.append(call)
        target(rows, call)
        if len(calls) == 2:
            raise OSError("gone")

    try:
        batches.append_in_batches(products, ["product_id"], fails_once, run, 50, 10)
    except OSError:
        pass
    batches.append_in_batches(products, ["product_id"], fails_once, run, 50, 10)
    n = batches.committed(spark, run).agg(F.count_distinct("batch")).scalar()
    rows = spark.read.schema(products.schema).option("recursiveFileLookup", True).parquet(f"{run}/target")
    return rows.withColumn("n_batches", n)
