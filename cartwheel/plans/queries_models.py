"""Queries: imputation, evaluation, recommender, segments, search."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions import scores
from cartwheel.functions.text import clean_id
from cartwheel.operators import evaluate, features, impute, joins, postings, quality, ranking, recommend, search, segment, vectors
from cartwheel.plans.inputs import CANDIDATES_SQL, RFM_SQL, SEGPOP_SQL, candidate_rows, rounded, segments
from cartwheel.plans.queries_quality import CATALOG_SQL, catalog
from cartwheel.plans.registry import query
from cartwheel.plans.star import load_star
from cartwheel.session import scratch


# Users the lookups ask about.
ASKED_USERS = [1, 100, 1000]


def lines_of(star):
    return joins.all_lines(star.prior, star.train)


# -- imputation --------------------------------------------------------------------------------------------------

USERS_SQL = """
i_last AS (SELECT user_id, order_id, order_number, COALESCE(days_since_prior_order, 0) AS days FROM (SELECT *,
    ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY order_number DESC, order_id) AS rn FROM b_orders) t WHERE rn = 1),
i_users AS (SELECT user_id, NULLIF(days, 30) AS days_imp, order_number AS frequency FROM i_last),
i_zero AS (SELECT * REPLACE (COALESCE(days_since_prior_order, 0) AS days_since_prior_order) FROM b_orders),
i_mask AS (SELECT order_id, user_id FROM i_last WHERE days = 30),
i_kept AS (SELECT * FROM i_zero WHERE order_id NOT IN (SELECT order_id FROM i_mask)),
i_fill AS (SELECT order_id, CAST(round_even(COALESCE(est, med, (SELECT quantile_cont(days_since_prior_order, 0.5) FROM i_kept)), 0) AS INT) AS fill
  FROM i_mask
  LEFT JOIN (SELECT user_id, CAST(user_id % 30 AS DOUBLE) AS est FROM i_users WHERE user_id % 3 <> 0) e USING (user_id)
  LEFT JOIN (SELECT user_id, quantile_cont(days_since_prior_order, 0.5) AS med FROM i_kept WHERE user_id % 2 = 0 OR TRUE GROUP BY 1) m USING (user_id)),
i_orders AS (SELECT b.* REPLACE (COALESCE(fill, b.days_since_prior_order) AS days_since_prior_order)
  FROM i_zero b LEFT JOIN i_fill USING (order_id))
""".replace("WHERE user_id % 2 = 0 OR TRUE ", "")


def fixed_estimates(users):
    """Estimates that can be written in SQL; users divisible by three have none, so the medians are used as well."""
    estimate = F.when(F.col("user_id") % 3 != 0, (F.col("user_id") % 30).cast("int"))
    return users.select("user_id", estimate.alias("days_imp_imputed"))


def imputed(star):
    return impute.backfill_orders(star.orders, fixed_estimates(impute.imputation_users(star.orders)))


@query("imputation_users", f", {USERS_SQL} SELECT * FROM i_users")
def imputation_users(spark, sf_dir):
    return impute.imputation_users(load_star(spark, sf_dir).orders)


@query(
    "nearest_donors",
    f""", {USERS_SQL}, p AS (SELECT user_id, days_imp, c.chain, (user_id * (37 + c.chain)) % 1009 + frequency / 8.0::DOUBLE AS predicted
      FROM i_users, (SELECT unnest([0, 1]) AS chain) c),
    r AS (SELECT m.user_id, m.chain, d.user_id AS donor, d.days_imp, CAST(ROW_NUMBER() OVER (PARTITION BY m.user_id, m.chain
        ORDER BY abs(d.predicted - m.predicted), d.predicted > m.predicted OR (d.predicted = m.predicted AND d.user_id > m.user_id),
        CASE WHEN d.predicted > m.predicted OR (d.predicted = m.predicted AND d.user_id > m.user_id) THEN d.user_id ELSE -d.user_id END) AS INT) AS rank
      FROM p m JOIN p d ON m.chain = d.chain AND m.days_imp IS NULL AND d.days_imp IS NOT NULL)
    SELECT user_id, CAST(chain AS INT) AS chain, rank, donor, CAST(days_imp AS INT) AS days_imp FROM r WHERE rank <= 5""",
)
def nearest_donors(spark, sf_dir):
    """Donor sets of the imputation for predictions that don't hang on drawn coefficients."""
    users = impute.imputation_users(load_star(spark, sf_dir).orders)
    chains = users.withColumn("chain", F.explode(F.array(F.lit(0), F.lit(1))))
    at = (F.col("user_id") * (37 + F.col("chain"))) % 1009 + F.col("frequency") / 8.0
    predicted = chains.select("user_id", F.col("days_imp").cast("int").alias("days_imp"), "chain", at.alias("predicted"))
    found = impute.nearest_donors(predicted, 5)
    listed = found.select("user_id", "chain", F.posexplode("donors").alias("at", "d"))
    return listed.select("user_id", "chain", (F.col("at") + 1).alias("rank"), F.col("d.user_id").alias("donor"), F.col("d.days_imp").alias("days_imp"))


@query("impute_pmm")
def impute_pmm(spark, sf_dir):
    return impute.impute_pmm(impute.imputation_users(load_star(spark, sf_dir).orders))


@query(
    "impute_pmm_observed",
    f""", {USERS_SQL}, r AS (SELECT MIN(days_imp) AS low, MAX(days_imp) AS high FROM i_users)
    SELECT user_id, CAST(days_imp AS INT) AS days_imp, TRUE AS filled, TRUE AS kept, TRUE AS in_range FROM i_users""",
)
def impute_pmm_observed(spark, sf_dir):
    """What holds for any draw: observed gaps stay, every gap is filled, within the range of the observed ones."""
    users = impute.imputation_users(load_star(spark, sf_dir).orders).select("user_id", F.col("days_imp").cast("int").alias("days_imp"), "frequency")
    low, high = users.agg(F.min("days_imp")).scalar(), users.agg(F.max("days_imp")).scalar()
    done, value = impute.impute_pmm(users), F.col("days_imp_imputed")
    return users.join(done, "user_id").select(
        "user_id", "days_imp", value.isNotNull().alias("filled"),
        (F.col("days_imp").isNull() | (F.col("days_imp") == value)).alias("kept"), value.between(low, high).alias("in_range"),
    )


@query("backfill_orders", f", {USERS_SQL} SELECT * FROM i_orders")
def backfill_orders(spark, sf_dir):
    return imputed(load_star(spark, sf_dir))


@query(
    "imputation_audit",
    f""", {USERS_SQL} SELECT user_id, days_imp, frequency,
    CASE WHEN user_id % 3 <> 0 THEN CAST(user_id % 30 AS INT) END AS days_imp_imputed FROM i_users""",
)
def imputation_audit(spark, sf_dir):
    users = impute.imputation_users(load_star(spark, sf_dir).orders)
    return impute.imputation_audit(users, fixed_estimates(users))


@query(
    "imputation_metrics",
    f""", {USERS_SQL} SELECT (SELECT COUNT(*) FROM b_orders) AS input_rows, COUNT(*) AS user_rows,
    COUNT(*) FILTER (WHERE days_imp IS NULL) AS missing_after_mask FROM i_users""",
)
def imputation_metrics(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return impute.imputation_metrics(star.orders, impute.imputation_users(star.orders))


def share_sql(table: str) -> str:
    return f"""(SELECT (SELECT COUNT(*) FROM {table}) AS total_rows, COUNT(*) AS num_users,
    CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM {table}) AS share_last_rows,
    COUNT(*) FILTER (WHERE days_since_prior_order = 30) AS last_eq30_count,
    CAST(COUNT(*) FILTER (WHERE days_since_prior_order = 30) AS DOUBLE) / COUNT(*) AS share_last_eq30
    FROM {table} WHERE order_id IN (SELECT order_id FROM i_last))"""


@query(
    "last_order_share",
    f""", {USERS_SQL} SELECT total_rows, num_users, ROUND(share_last_rows, 6) AS share_last_rows, last_eq30_count,
    ROUND(share_last_eq30, 6) AS share_last_eq30 FROM {share_sql('b_orders')}""",
)
def last_order_share(spark, sf_dir):
    return rounded(impute.last_order_share(load_star(spark, sf_dir).orders), "share_last_rows", "share_last_eq30")


@query(
    "last_order_delta",
    f""", {USERS_SQL} SELECT ROUND(b.share_last_rows, 6) AS share_last_rows_before, ROUND(b.share_last_eq30, 6) AS share_last_eq30_before,
    ROUND(a.share_last_rows, 6) AS share_last_rows_after, ROUND(a.share_last_eq30, 6) AS share_last_eq30_after,
    ROUND(a.share_last_rows - b.share_last_rows, 6) AS share_last_rows_delta,
    ROUND(a.share_last_eq30 - b.share_last_eq30, 6) AS share_last_eq30_delta
    FROM {share_sql('b_orders')} b, {share_sql('i_orders')} a""",
)
def last_order_delta(spark, sf_dir):
    star = load_star(spark, sf_dir)
    df = impute.last_order_delta(star.orders, imputed(star))
    return rounded(df, *df.columns)


def stats_sql(table: str) -> str:
    return f"""(SELECT COUNT(*) AS n, AVG(d) AS mean, quantile_cont(d, 0.5) AS median, quantile_cont(d, 0.1) AS p10,
    quantile_cont(d, 0.25) AS p25, quantile_cont(d, 0.75) AS p75, quantile_cont(d, 0.9) AS p90,
    AVG(CASE WHEN d <= 30 THEN 1.0 ELSE 0.0 END) AS share_le_30d
    FROM (SELECT CAST(days_since_prior_order AS DOUBLE) AS d FROM {table}
      WHERE days_since_prior_order > 0 AND days_since_prior_order < 730) v)"""


def valid(orders):
    return quality.valid_intervals(orders, "days_since_prior_order")


@query(
    "interval_stats",
    f"""SELECT n, ROUND(mean, 6) AS mean, ROUND(median, 6) AS median, ROUND(p10, 6) AS p10, ROUND(p25, 6) AS p25,
    ROUND(p75, 6) AS p75, ROUND(p90, 6) AS p90, ROUND(share_le_30d, 6) AS share_le_30d FROM {stats_sql('b_orders')} s""",
)
def interval_stats(spark, sf_dir):
    df = impute.interval_stats(valid(load_star(spark, sf_dir).orders))
    return rounded(df, *[c for c in df.columns if c != "n"])


@query(
    "interval_delta",
    f""", {USERS_SQL} SELECT ROUND(a.share_le_30d - b.share_le_30d, 6) AS delta_share_le_30d,
    ROUND(a.mean - b.mean, 6) AS delta_mean_days, ROUND(a.median - b.median, 6) AS delta_median_days
    FROM {stats_sql('b_orders')} b, {stats_sql('i_orders')} a""",
)
def interval_delta(spark, sf_dir):
    star = load_star(spark, sf_dir)
    df = impute.interval_delta(valid(star.orders), valid(imputed(star)))
    return rounded(df, *df.columns)


def histogram_sql(side: str, table: str) -> str:
    return f"""SELECT '{side}' AS side, bin, ROUND(ANY_VALUE(lo) + bin * ANY_VALUE(w), 6) AS left_edge, COUNT(*) AS n,
    ROUND(COUNT(*) / (ANY_VALUE(total) * ANY_VALUE(w)), 6) AS density FROM (
      SELECT CAST(LEAST(FLOOR((v - lo) * 60 / (hi - lo)), 59) AS INT) AS bin, lo, (hi - lo) / 60 AS w, total FROM (
        SELECT LEAST(CAST(days_since_prior_order AS DOUBLE), 60.0::DOUBLE) AS v,
          MIN(LEAST(CAST(days_since_prior_order AS DOUBLE), 60.0::DOUBLE)) OVER () AS lo,
          MAX(LEAST(CAST(days_since_prior_order AS DOUBLE), 60.0::DOUBLE)) OVER () AS hi, COUNT(*) OVER () AS total
        FROM {table} WHERE days_since_prior_order > 0 AND days_since_prior_order < 730) a) b GROUP BY bin"""


@query(
    "interval_histogram",
    f", {USERS_SQL} {histogram_sql('before', 'b_orders')} UNION ALL {histogram_sql('after', 'i_orders')}",
)
def interval_histogram(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return rounded(impute.histogram_before_after(valid(star.orders), valid(imputed(star))), "left_edge", "density")


# -- evaluation --------------------------------------------------------------------------------------------------

TRUTH_SQL = """
e_truth AS (SELECT DISTINCT user_id, product_id FROM b_train JOIN b_orders USING (order_id)),
e_size AS (SELECT user_id, COUNT(*) AS gt_size FROM e_truth GROUP BY 1),
e_top AS (SELECT product_id, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, product_id) - 1 AS pos FROM b_train GROUP BY 1),
e_pop AS (SELECT user_id, pos, product_id FROM e_size, e_top WHERE pos < 10)
"""


def metrics_sql(recs: str, k: int) -> str:
    """CTEs m_user for long lists ``recs`` (user_id, pos, product_id)."""
    return f"""
m_hit AS (SELECT r.user_id, r.pos, CASE WHEN t.product_id IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS rel
  FROM {recs} r LEFT JOIN e_truth t USING (user_id, product_id) WHERE r.pos < {k}),
m_cum AS (SELECT *, SUM(rel) OVER (PARTITION BY user_id ORDER BY pos) / (pos + 1) AS prec FROM m_hit),
m_list AS (SELECT user_id, SUM(rel) AS hits, SUM(prec * rel) AS ps, SUM(rel * ln(2) / ln(pos + 2)) AS dcg FROM m_cum GROUP BY 1),
m_ideal AS (SELECT n, SUM(ln(2) / ln(i + 1)) AS idcg FROM range(1, {k + 1}) a(n), range(1, {k + 1}) b(i) WHERE i <= n GROUP BY 1),
m_user AS (SELECT user_id, gt_size, hits, hits / {k} AS precision, hits / gt_size AS recall,
    CASE WHEN hits > 0 THEN ps / hits ELSE 0 END AS ap_hits, dcg / idcg AS ndcg
  FROM m_list JOIN e_size USING (user_id) JOIN m_ideal ON n = LEAST(gt_size, {k}))
"""


METRIC_COLUMNS = ("precision", "recall", "ap_hits", "ndcg")


def truth_of(star):
    return evaluate.ground_truth(star.train, star.orders)


@query("ground_truth", f", {TRUTH_SQL} SELECT * FROM e_truth")
def ground_truth(spark, sf_dir):
    return truth_of(load_star(spark, sf_dir))


@query(
    "ranking_metrics",
    f""", {CANDIDATES_SQL}, {TRUTH_SQL}, {metrics_sql('k_recs', 10)} SELECT user_id, gt_size, hits, ROUND(precision, 6) AS precision,
    ROUND(recall, 6) AS recall, ROUND(ap_hits, 6) AS ap_hits, ROUND(ndcg, 6) AS ndcg FROM m_user""",
)
def ranking_metrics(spark, sf_dir):
    star = load_star(spark, sf_dir)
    lists = recommend.to_lists(candidate_rows(star), "pos")
    return rounded(evaluate.ranking_metrics(lists, truth_of(star), 10), *METRIC_COLUMNS)


def baseline_metrics(star, k=10):
    truth = truth_of(star)
    return evaluate.ranking_metrics(evaluate.popularity_baseline(star.train, truth, k), truth, k)


@query(
    "ranking_summary",
    f""", {TRUTH_SQL}, {metrics_sql('e_pop', 10)} SELECT COUNT(*) AS users_evaluated, ROUND(AVG(precision), 6) AS precision,
    ROUND(AVG(recall), 6) AS recall, ROUND(AVG(ap_hits), 6) AS map, ROUND(AVG(ndcg), 6) AS ndcg FROM m_user""",
)
def ranking_summary(spark, sf_dir):
    return rounded(evaluate.ranking_summary(baseline_metrics(load_star(spark, sf_dir))), *evaluate.METRICS)


@query(
    "popularity_baseline",
    f""", {TRUTH_SQL} SELECT user_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY pos) AS rec_items FROM e_pop GROUP BY 1""",
)
def popularity_baseline(spark, sf_dir):
    star = load_star(spark, sf_dir)
    lists = evaluate.popularity_baseline(star.train, truth_of(star), 10)
    return lists.select("user_id", F.array_join(F.col("rec_items").cast("array<string>"), ",").alias("rec_items"))


LIFT_CTES = f"""
mp AS (SELECT AVG(precision) AS p, AVG(recall) AS r, AVG(ap_hits) AS m, AVG(ndcg) AS n, COUNT(*) AS users FROM m_user)
"""


@query(
    "lift",
    f""", {CANDIDATES_SQL}, {TRUTH_SQL}, {metrics_sql('k_recs', 10)}, {LIFT_CTES},
    {metrics_sql('e_pop', 10).replace('m_', 'q_')},
    bp AS (SELECT AVG(precision) AS p, AVG(recall) AS r, AVG(ap_hits) AS m, AVG(ndcg) AS n FROM q_user)
    SELECT mp.users AS users_evaluated, ROUND(mp.p, 6) AS model_precision, ROUND(mp.r, 6) AS model_recall, ROUND(mp.m, 6) AS model_map,
    ROUND(mp.n, 6) AS model_ndcg, ROUND(bp.p, 6) AS baseline_precision, ROUND(bp.r, 6) AS baseline_recall, ROUND(bp.m, 6) AS baseline_map,
    ROUND(bp.n, 6) AS baseline_ndcg, ROUND(CASE WHEN bp.p <> 0 THEN (mp.p - bp.p) / bp.p END, 6) AS lift_precision,
    ROUND(CASE WHEN bp.r <> 0 THEN (mp.r - bp.r) / bp.r END, 6) AS lift_recall,
    ROUND(CASE WHEN bp.m <> 0 THEN (mp.m - bp.m) / bp.m END, 6) AS lift_map,
    ROUND(CASE WHEN bp.n <> 0 THEN (mp.n - bp.n) / bp.n END, 6) AS lift_ndcg FROM mp, bp""",
)
def lift(spark, sf_dir):
    star = load_star(spark, sf_dir)
    lists = recommend.to_lists(candidate_rows(star), "pos")
    model = evaluate.ranking_summary(evaluate.ranking_metrics(lists, truth_of(star), 10))
    both = evaluate.metrics_lift(model, evaluate.ranking_summary(baseline_metrics(star)))
    return rounded(both, *[c for c in both.columns if c != "users_evaluated"])


@query(
    "coverage",
    f""", {CANDIDATES_SQL}, {TRUTH_SQL}, c AS (SELECT (SELECT COUNT(*) FROM e_size) AS users_with_gt,
      (SELECT COUNT(DISTINCT user_id) FROM k_recs) AS users_with_recs,
      (SELECT COUNT(DISTINCT user_id) FROM k_recs JOIN e_size USING (user_id)) AS users_evaluated,
      (SELECT COUNT(DISTINCT product_id) FROM b_train) AS catalog_size,
      (SELECT COUNT(DISTINCT product_id) FROM k_recs) AS items_recommended)
    SELECT *, ROUND(CAST(users_with_recs AS DOUBLE) / users_with_gt, 6) AS coverage_user_rec,
    ROUND(CAST(users_evaluated AS DOUBLE) / users_with_gt, 6) AS coverage_user_eval,
    ROUND(CAST(items_recommended AS DOUBLE) / catalog_size, 6) AS coverage_item FROM c""",
)
def coverage(spark, sf_dir):
    star = load_star(spark, sf_dir)
    df = evaluate.coverage(recommend.to_lists(candidate_rows(star), "pos"), truth_of(star), star.train)
    return rounded(df, "coverage_user_rec", "coverage_user_eval", "coverage_item")


# -- re-ranking --------------------------------------------------------------------------------------------------

BLEND_SQL = """
z_log AS (SELECT product_id, ln(1 + COUNT(*)) AS logc FROM b_train GROUP BY 1),
z_pop AS (SELECT product_id, (logc - (SELECT AVG(logc) FROM z_log)) / (SELECT stddev_samp(logc) FROM z_log) AS pop_z FROM z_log),
z_base AS (SELECT user_id, pos, product_id, score, 0.7::DOUBLE * CASE WHEN stddev_pop(score) OVER (PARTITION BY user_id) > 0
      THEN (score - AVG(score) OVER (PARTITION BY user_id)) / stddev_pop(score) OVER (PARTITION BY user_id) ELSE 0 END
    + 0.3::DOUBLE * COALESCE(pop_z, 0) AS base FROM k_recs LEFT JOIN z_pop USING (product_id)),
z_rank AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY base DESC, product_id) AS INT) AS rank FROM z_base)
"""


@query("popularity_z", f", {BLEND_SQL.split('z_base')[0].strip().rstrip(',')} SELECT product_id, ROUND(pop_z, 6) AS pop_z FROM z_pop")
def popularity_z(spark, sf_dir):
    return rounded(recommend.popularity_z(load_star(spark, sf_dir).train), "pop_z")


def blended(star):
    return recommend.blend(candidate_rows(star), recommend.popularity_z(star.train))


@query(
    "blend",
    f", {CANDIDATES_SQL}, {BLEND_SQL} SELECT user_id, pos, product_id, ROUND(score, 6) AS score, ROUND(base, 6) AS base, rank FROM z_rank",
)
def blend(spark, sf_dir):
    return rounded(blended(load_star(spark, sf_dir)), "score", "base")


def joined_items(lists):
    return lists.select("user_id", F.array_join(F.col("rec_items").cast("array<string>"), ",").alias("rec_items"))


@query(
    "backfill",
    f""", {CANDIDATES_SQL}, {BLEND_SQL}, {TRUTH_SQL},
    s_seen AS (SELECT DISTINCT user_id, product_id FROM b_prior JOIN b_orders USING (order_id)),
    s_pool AS (SELECT user_id, rank AS place, product_id FROM z_rank WHERE rank <= 4
      UNION ALL SELECT user_id, 1000 + pos, e_top.product_id FROM (SELECT DISTINCT user_id FROM z_rank) u, e_top WHERE pos < 10),
    s_once AS (SELECT user_id, product_id, MIN(place) AS place FROM s_pool GROUP BY 1, 2),
    s_num AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY place) AS rn FROM s_once)
    SELECT user_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY rn) AS rec_items FROM s_num WHERE rn <= 10 GROUP BY 1""",
)
def backfill(spark, sf_dir):
    star = load_star(spark, sf_dir)
    short = recommend.to_lists(blended(star).filter("rank <= 4"))
    return joined_items(recommend.backfill(short, evaluate.top_items(star.train, 10), 10))


@query(
    "filter_seen",
    f""", {CANDIDATES_SQL} SELECT user_id, pos, product_id, ROUND(score, 6) AS score FROM k_recs
    WHERE (user_id, product_id) NOT IN (SELECT DISTINCT user_id, product_id FROM b_prior JOIN b_orders USING (order_id))""",
)
def filter_seen(spark, sf_dir):
    star = load_star(spark, sf_dir)
    seen = evaluate.ground_truth(star.prior, star.orders)
    return rounded(recommend.filter_seen(candidate_rows(star), seen), "score")


def grouped_vectors(spark, sf_dir):
    """Product vectors taken from the embeddings table, reused in turn over the catalog."""
    star = load_star(spark, sf_dir)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vector"))
    n = vectors.agg(F.count(F.lit(1))).scalar()
    return star.products.select("product_id", (F.col("product_id") % n).alias("vec_id")).join(vectors, "vec_id").drop("vec_id")


def mmr_sql(pool: str, k: int = 10, lam: float = 0.3) -> str:
    """CTEs for the greedy choice, one per step, over ``pool`` (user_id, pos, product_id, base); the result is y_list
    (user_id, place, product_id): the chosen products, then the rest in pool order."""
    ctes = [
        f"""y_vec AS (SELECT p.product_id, CAST(v.embedding AS DOUBLE[]) AS x FROM b_products p
      JOIN embeddings v ON v.vec_id = p.product_id % (SELECT COUNT(*) FROM embeddings)),
    y_pool AS (SELECT user_id, pos, product_id, base, x FROM {pool} JOIN y_vec USING (product_id)),
    y_sim AS (SELECT a.user_id, a.pos, b.pos AS other, GREATEST(0, list_dot_product(a.x, b.x)
      / (SQRT(list_dot_product(a.x, a.x)) * SQRT(list_dot_product(b.x, b.x)))) AS sim
      FROM y_pool a JOIN y_pool b ON a.user_id = b.user_id AND a.pos <> b.pos),
    y_0 AS (SELECT user_id, pos, 0 AS place FROM y_pool
      QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY base DESC, pos) = 1)"""
    ]
    for step in range(1, k):
        ctes.append(
            f"""y_{step} AS (SELECT * FROM y_{step - 1} UNION ALL (SELECT user_id, pos, {step} AS place FROM (
        SELECT p.user_id, p.pos, {lam}::DOUBLE * ANY_VALUE(p.base) - (1 - {lam}::DOUBLE) * MAX(s.sim) AS value
        FROM y_pool p JOIN y_sim s ON s.user_id = p.user_id AND s.pos = p.pos
        JOIN y_{step - 1} c ON c.user_id = p.user_id AND c.pos = s.other
        WHERE (p.user_id, p.pos) NOT IN (SELECT user_id, pos FROM y_{step - 1}) GROUP BY 1, 2) v
      QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value DESC, pos) = 1))"""
        )
    ctes.append(
        f"""y_list AS (SELECT user_id, COALESCE(c.place, 100 + p.pos) AS place, product_id
      FROM y_pool p LEFT JOIN y_{k - 1} c USING (user_id, pos))"""
    )
    return ",\n".join(c.replace("AS (SELECT * FROM y_", "AS MATERIALIZED (SELECT * FROM y_") for c in ctes)


LISTED = "string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY place) AS rec_items"


@query("mmr", f", {CANDIDATES_SQL}, {BLEND_SQL}, {mmr_sql('z_base')} SELECT user_id, {LISTED} FROM y_list GROUP BY 1")
def mmr(spark, sf_dir):
    return joined_items(recommend.mmr(blended(load_star(spark, sf_dir)), grouped_vectors(spark, sf_dir)))


@query(
    "rerank",
    f""", k_all AS (SELECT * FROM ({CANDIDATES_SQL.strip().removeprefix('k_recs AS (').removesuffix(')')}) c),
    k_recs AS (SELECT * FROM k_all WHERE (user_id, product_id) NOT IN
      (SELECT DISTINCT user_id, product_id FROM b_prior JOIN b_orders USING (order_id))),
    {BLEND_SQL}, {mmr_sql('z_base')}, {TRUTH_SQL},
    w_pool AS (SELECT * FROM y_list
      UNION ALL SELECT user_id, 1000 + pos, e_top.product_id FROM (SELECT DISTINCT user_id FROM y_list) u, e_top WHERE pos < 10),
    w_once AS (SELECT user_id, product_id, MIN(place) AS place FROM w_pool GROUP BY 1, 2),
    w_ten AS (SELECT * FROM w_once QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY place) <= 10)
    SELECT user_id, {LISTED} FROM w_ten GROUP BY 1""",
)
def rerank(spark, sf_dir):
    star = load_star(spark, sf_dir)
    top = evaluate.top_items(star.train, 10)
    seen = evaluate.ground_truth(star.prior, star.orders)
    lists = recommend.rerank(
        candidate_rows(star), star.train, top, vectors=grouped_vectors(spark, sf_dir), seen=seen
    )
    return joined_items(lists)


SCORE_INPUT = "SELECT order_id, (order_id % 400) / 100.0::DOUBLE - 1 AS raw, order_id % 60000 AS cnt FROM b_orders"


@query(
    "normalize_score",
    f""", x AS ({SCORE_INPUT}), n AS (SELECT *, (LEAST(GREATEST(raw, 0), 2) - 0) / 2 AS m FROM x)
    SELECT order_id, ROUND(m, 6) AS model, ROUND((LEAST(GREATEST(raw, -0.05::DOUBLE), 0.9::DOUBLE) + 0.05) / 0.95, 6) AS observed,
    ROUND((LEAST(GREATEST(CAST(cnt AS DOUBLE), 1), 45000) - 1) / 44999, 6) AS popularity, ROUND(1 / (1 + exp(-raw / 0.5)), 6) AS sigmoid,
    CASE WHEN m >= 0.7::DOUBLE THEN 'VERY_HIGH' WHEN m >= 0.5 THEN 'HIGH' WHEN m >= 0.3::DOUBLE THEN 'MEDIUM' WHEN m >= 0.1::DOUBLE THEN 'LOW'
      ELSE 'VERY_LOW' END AS confidence FROM n""",
)
def normalize_score(spark, sf_dir):
    oid = F.col("order_id")
    x = load_star(spark, sf_dir).orders.select("order_id", ((oid % 400) / F.lit(100.0) - 1).alias("raw"), (oid % 60000).alias("cnt"))
    model = scores.normalize(F.col("raw"))
    df = x.select(
        "order_id",
        model.alias("model"),
        scores.normalize(F.col("raw"), scores.OBSERVED_BOUNDS).alias("observed"),
        scores.normalize(F.col("cnt").cast("double"), scores.POPULARITY_BOUNDS).alias("popularity"),
        scores.sigmoid(F.col("raw")).alias("sigmoid"),
        scores.confidence_band(model).alias("confidence"),
    )
    return rounded(df, "model", "observed", "popularity", "sigmoid")


@query(
    "popular_fallback",
    f""", {CANDIDATES_SQL}, {TRUTH_SQL}, l AS (SELECT user_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY pos) AS items
      FROM k_recs JOIN e_size USING (user_id) GROUP BY 1),
    t AS (SELECT string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY pos) AS items FROM e_top WHERE pos < 10)
    SELECT user_id, COALESCE(l.items, t.items) AS rec_items, CASE WHEN l.items IS NULL THEN 'popular' ELSE 'model' END AS source
    FROM (SELECT DISTINCT user_id FROM b_orders) u LEFT JOIN l USING (user_id), t""",
)
def popular_fallback(spark, sf_dir):
    star = load_star(spark, sf_dir)
    known = truth_of(star).select("user_id").distinct()
    lists = recommend.to_lists(candidate_rows(star), "pos").join(known, "user_id", "left_semi")
    df = recommend.popular_fallback(star.orders, lists, evaluate.top_items(star.train, 10))
    return df.withColumn("rec_items", F.array_join(F.col("rec_items").cast("array<string>"), ","))


@query(
    "score_ranges",
    f""", {CANDIDATES_SQL}, c AS (SELECT COUNT(*) AS n FROM b_prior GROUP BY product_id)
    SELECT 'candidates' AS kind, ROUND(MIN(score), 6) AS min_score, ROUND(MAX(score), 6) AS max_score, ROUND(AVG(score), 6) AS mean_score,
    ROUND(stddev_pop(score), 6) AS std_score, ROUND(MAX(score) - MIN(score), 6) AS range_score FROM k_recs
    UNION ALL SELECT 'popularity', MIN(n), MAX(n), ROUND(AVG(n), 6), ROUND(stddev_pop(n), 6), MAX(n) - MIN(n) FROM c""",
)
def score_ranges(spark, sf_dir):
    star = load_star(spark, sf_dir)
    counts = star.prior.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    both = recommend.score_ranges(candidate_rows(star), "score", "candidates").unionByName(
        recommend.score_ranges(counts, "n", "popularity")
    )
    return rounded(both, *[c for c in both.columns if c != "kind"])


# -- trained model -----------------------------------------------------------------------------------------------

_MODELS: dict = {}


def trained(spark, sf_dir):
    """Model of the prior purchases, trained once per application and folder. The ratings are written first: training
    passes over them many times."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        star = load_star(spark, sf_dir)
        path = scratch(spark, "ratings")
        features.ratings(star.prior, star.orders).write.parquet(path)
        _MODELS[key] = recommend.train_als(spark.read.parquet(path))
    return _MODELS[key]


@query(
    "train_als",
    """, r AS (SELECT user_id, product_id, 1 + ln(1 + COUNT(*)) AS rating FROM b_prior JOIN b_orders USING (order_id) GROUP BY 1, 2)
    SELECT COUNT(*) AS cnt, ROUND(MIN(rating), 6) AS min_rating, ROUND(MAX(rating), 6) AS max_rating, ROUND(AVG(rating), 6) AS avg_rating,
    COUNT(DISTINCT user_id) AS users, COUNT(DISTINCT product_id) AS items, 64::BIGINT AS factors FROM r""",
)
def train_als(spark, sf_dir):
    """What the model was trained on, and the size of its factor tables."""
    model, meta = trained(spark, sf_dir)
    stats = rounded(spark.createDataFrame([meta]), "min_rating", "max_rating", "avg_rating")
    users, items = model.model.userFactors, model.model.itemFactors
    return stats.select(
        "cnt",
        "min_rating",
        "max_rating",
        "avg_rating",
        users.agg(F.count(F.lit(1))).scalar().alias("users"),
        items.agg(F.count(F.lit(1))).scalar().alias("items"),
        items.agg(F.max(F.size("features")).cast("long")).scalar().alias("factors"),
    )


@query("train_als_counts")
def train_als_counts(spark, sf_dir):
    star = load_star(spark, sf_dir)
    model, _ = recommend.train_als_counts(features.purchase_counts(star.prior, star.orders))
    vectors = recommend.item_vectors(model)
    return rounded(vectors.select("product_id", scores.norm(F.col("vector")).alias("norm")), "norm", digits=3)


@query(
    "train_als_counts_keys",
    """SELECT DISTINCT product_id, TRUE AS finite, TRUE AS in_range FROM b_prior JOIN b_orders USING (order_id)""",
)
def train_als_counts_keys(spark, sf_dir):
    """What holds whatever the factors are: every bought product has one vector, of finite numbers and finite length."""
    star = load_star(spark, sf_dir)
    model, _ = recommend.train_als_counts(features.purchase_counts(star.prior, star.orders))
    vectors = recommend.item_vectors(model).withColumn("norm", scores.norm(F.col("vector")))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select("product_id", finite.alias("finite"), ((F.col("norm") >= 0) & (F.col("norm") < float("inf"))).alias("in_range"))


@query("recommend_all")
def recommend_all(spark, sf_dir):
    return joined_items(recommend.recommend_all(trained(spark, sf_dir)[0], 10))


@query("recommend_subset")
def recommend_subset(spark, sf_dir):
    users = truth_of(load_star(spark, sf_dir)).select("user_id")
    return rounded(recommend.recommend_subset(trained(spark, sf_dir)[0], users, 10).drop("pos"), "score", digits=3)


@query("score_pairs")
def score_pairs(spark, sf_dir):
    return recommend.score_pairs(trained(spark, sf_dir)[0], truth_of(load_star(spark, sf_dir)))


@query(
    "similar_users",
    """, e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
    s AS (SELECT a.vec_id AS user_id, b.vec_id AS similar_user_id, ROUND(list_dot_product(a.v, b.v)
      / (SQRT(list_dot_product(a.v, a.v)) * SQRT(list_dot_product(b.v, b.v)) + 1e-10), 6) AS similarity
      FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
    r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY similarity DESC, similar_user_id) AS INT) AS rank FROM s)
    SELECT * FROM r WHERE rank <= 5""",
)
def similar_users(spark, sf_dir):
    """Every fiftieth vector is asked for."""
    known = embeddings(spark, sf_dir)
    return recommend.similar_users(known, known.where("id % 50 = 0").select(F.col("id").alias("user_id")), 5)


def embeddings(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


@query(
    "similar_vectors_indexed",
    """, e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
    s AS (SELECT a.vec_id AS query_id, b.vec_id, b.label, ROUND(list_dot_product(a.v, b.v)
      / (SQRT(list_dot_product(a.v, a.v)) * SQRT(list_dot_product(b.v, b.v)) + 1e-10), 6) AS similarity
      FROM e a JOIN e b ON a.vec_id % 20 = 0),
    r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS INT) AS rank FROM s)
    SELECT query_id, vec_id, similarity, rank, label FROM r WHERE rank <= 10""",
)
def similar_vectors_indexed(spark, sf_dir):
    """The ten vectors closest to every twentieth one, through an index of all."""
    base, known = spark.read.parquet(f"{sf_dir}/embeddings.parquet"), embeddings(spark, sf_dir)
    return search.similar_vectors(base, known.where("id % 20 = 0"), 10, index=vectors.build_index(known))


@query(
    "vector_index_clusters",
    """SELECT COUNT(*) AS n_vectors, CAST(CEIL(COUNT(*) / 50.0) AS BIGINT) AS n_queries, TRUE AS few_vectors_compared,
      TRUE AS within_radius FROM embeddings""",
)
def vector_index_clusters(spark, sf_dir):
    """What holds of any index: every vector is in one cluster, and under 30 % of the pairs are compared as vectors."""
    known = embeddings(spark, sf_dir)
    index = vectors.build_index(known)
    shares = vectors.search(index, known.where("id % 50 = 0"), 5).shares()
    bad = index.clusters.agg(F.count_if(F.col("low") > F.col("high"))).scalar()
    return shares.select("n_vectors", "n_queries", (F.col("vectors_share") < 0.3).alias("few_vectors_compared"), (bad == 0).alias("within_radius"))


def stretched(spark, sf_dir):
    """Products of very different length: embeddings times a power of their number's remainder."""
    length = F.pow(F.lit(1.2), F.col("id") % 40)
    return embeddings(spark, sf_dir).withColumn("vector", F.transform("vector", lambda x: x.cast("double") * length))


STRETCHED_SQL = """e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
      list_transform(embedding, lambda x: CAST(x AS DOUBLE) * POW(1.2::DOUBLE, vec_id % 40)) AS w FROM embeddings)"""


@query(
    "largest_products",
    f""", {STRETCHED_SQL}, s AS (SELECT a.vec_id AS user_id, b.vec_id AS product_id, ROUND(list_dot_product(a.v, b.w), 6) AS score FROM e a, e b),
    r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS INT) AS rank FROM s)
    SELECT user_id, product_id, score, rank FROM r WHERE rank <= 10""",
)
def largest_products(spark, sf_dir):
    """The ten products with the largest inner product for every user, on fixed factors."""
    found = vectors.largest_products(stretched(spark, sf_dir), embeddings(spark, sf_dir), 10, block=64).found
    return found.select(F.col("query_id").alias("user_id"), F.col("id").alias("product_id"), "score", "rank")


@query("largest_products_share", "SELECT COUNT(*) * COUNT(*) AS pairs, TRUE AS pruned FROM embeddings")
def largest_products_share(spark, sf_dir):
    """Bounds by norm leave out over two fifths of the pairs on these factors."""
    shares = vectors.largest_products(stretched(spark, sf_dir), embeddings(spark, sf_dir), 10, block=64).shares
    return shares.select("pairs", (F.col("share") < 0.6).alias("pruned"))


@query(
    "popular_by_norm",
    """, n AS (SELECT vec_id AS product_id, SQRT(list_dot_product(list_transform(embedding, lambda x: CAST(x AS DOUBLE)),
      list_transform(embedding, lambda x: CAST(x AS DOUBLE)))) AS norm FROM embeddings)
    SELECT product_id, ROUND(norm, 6) AS norm FROM n ORDER BY ROUND(n.norm, 9) DESC, product_id LIMIT 10""",
)
def popular_by_norm(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = recommend.popular_by_norm(vectors.select(F.col("vec_id").alias("product_id"), F.col("embedding").alias("vector")), 10)
    return rounded(found.select("product_id", "norm"), "norm")


@query("model_evaluation")
def model_evaluation(spark, sf_dir):
    """Train, take candidates, blend and diversify, fill up, compare with the popularity baseline."""
    star = load_star(spark, sf_dir)
    model = trained(spark, sf_dir)[0]
    recs = recommend.all_candidates(model, recommend.CANDIDATES)
    top = evaluate.top_items(star.train, 10)
    lists = recommend.rerank(recs, star.train, top, vectors=recommend.item_vectors(model))
    ours = evaluate.ranking_summary(evaluate.ranking_metrics(lists, truth_of(star), 10))
    return evaluate.metrics_lift(ours, evaluate.ranking_summary(baseline_metrics(star)))


@query(
    "model_evaluation_baseline",
    f""", {TRUTH_SQL}, {metrics_sql('e_pop', 10)}, k AS (SELECT DISTINCT user_id FROM b_prior JOIN b_orders USING (order_id)),
    n AS (SELECT COUNT(*) AS users_evaluated FROM m_user JOIN k USING (user_id))
    SELECT ANY_VALUE(users_evaluated) AS users_evaluated, ROUND(AVG(precision), 6) AS baseline_precision,
    ROUND(AVG(recall), 6) AS baseline_recall, ROUND(AVG(ap_hits), 6) AS baseline_map, ROUND(AVG(ndcg), 6) AS baseline_ndcg FROM m_user, n""",
)
def model_evaluation_baseline(spark, sf_dir):
    """The part of the evaluation that doesn't hang on the factors: whom the model has lists for, and the baseline."""
    columns = [f"baseline_{m}" for m in evaluate.METRICS]
    return rounded(model_evaluation(spark, sf_dir).select("users_evaluated", *columns), *columns)


@query(
    "recommend_all_keys",
    """, p AS (SELECT COUNT(DISTINCT product_id) AS n FROM b_prior)
    SELECT user_id, CAST(LEAST(10, ANY_VALUE(n)) AS BIGINT) AS products, TRUE AS known
    FROM b_prior JOIN b_orders USING (order_id), p GROUP BY 1""",
)
def recommend_all_keys(spark, sf_dir):
    """What the lists must hold whatever the factors are: every trained user, ten different trained products."""
    trained_on = load_star(spark, sf_dir).prior.select("product_id").distinct().withColumn("seen", F.lit(True))
    rows = recommend.all_candidates(trained(spark, sf_dir)[0], 10).join(trained_on, "product_id", "left")
    return rows.groupBy("user_id").agg(
        F.count_distinct("product_id").alias("products"), F.every(F.col("seen").isNotNull()).alias("known")
    )


@query(
    "recommend_subset_keys",
    """, t AS (SELECT DISTINCT user_id FROM b_train JOIN b_orders USING (order_id)),
    k AS (SELECT DISTINCT user_id FROM b_prior JOIN b_orders USING (order_id)),
    p AS (SELECT COUNT(DISTINCT product_id) AS n FROM b_prior)
    SELECT user_id, CAST(LEAST(10, n) AS BIGINT) AS products, TRUE AS falling FROM t JOIN k USING (user_id), p""",
)
def recommend_subset_keys(spark, sf_dir):
    """Users that are known to the model, with as many products as asked for in falling order of their scores."""
    users = truth_of(load_star(spark, sf_dir)).select("user_id")
    rows = recommend.recommend_subset(trained(spark, sf_dir)[0], users, 10)
    lists = rows.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("pos", "score", "product_id"))).alias("r"))
    falling = F.array_sort(F.transform("r", lambda x: -x["score"])) == F.transform("r", lambda x: -x["score"])
    return lists.select("user_id", F.size(F.array_distinct(F.col("r.product_id"))).cast("long").alias("products"), falling.alias("falling"))


@query(
    "score_pairs_keys",
    """, t AS (SELECT DISTINCT user_id, product_id FROM b_train JOIN b_orders USING (order_id)),
    u AS (SELECT DISTINCT user_id FROM b_prior JOIN b_orders USING (order_id)), i AS (SELECT DISTINCT product_id FROM b_prior)
    SELECT user_id, product_id, TRUE AS in_bounds, u.user_id IS NULL OR i.product_id IS NULL AS unknown
    FROM t LEFT JOIN u USING (user_id) LEFT JOIN i USING (product_id)""",
)
def score_pairs_keys(spark, sf_dir):
    """One score for each pair, normalised ones between 0 and 1, and 0 for pairs that the model can't know."""
    star = load_star(spark, sf_dir)
    users = star.prior.join(star.orders.select("order_id", "user_id"), "order_id").select("user_id").distinct()
    unknown = truth_of(star).join(users.withColumn("u", F.lit(1)), "user_id", "left").join(
        star.prior.select("product_id").distinct().withColumn("i", F.lit(1)), "product_id", "left"
    ).select("user_id", "product_id", (F.col("u").isNull() | F.col("i").isNull()).alias("unknown"))
    done = recommend.score_pairs(trained(spark, sf_dir)[0], truth_of(star)).join(unknown, ["user_id", "product_id"])
    fine = F.col("normalized_score").between(0, 1) & (~F.col("unknown") | (F.col("score") == 0))
    return done.select("user_id", "product_id", fine.alias("in_bounds"), "unknown")


# -- segments ----------------------------------------------------------------------------------------------------


def fixed_segments(star):
    return segments(star, segment.rfm(star.orders, star.train))


def popularity_of(star):
    return segment.segment_popularity(fixed_segments(star), star.orders, lines_of(star))


@query("rfm", f', {RFM_SQL} SELECT user_id, "R", "F", ROUND("M", 6) AS "M" FROM g_rfm')
def rfm(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return rounded(segment.rfm(star.orders, star.train), "M")


@query("segment_users")
def segment_users(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return segment.segment_users(segment.rfm(star.orders, star.train))


@query(
    "segment_users_members",
    f""", {RFM_SQL} SELECT user_id, "R", "F", ROUND("M", 6) AS "M", TRUE AS in_segments FROM g_rfm""",
)
def segment_users_members(spark, sf_dir):
    """Every user has one of the segments, with its measures unchanged."""
    done = segment_users(spark, sf_dir)
    return rounded(done.select("user_id", "R", "F", "M", F.col("segment").between(0, segment.SEGMENTS - 1).alias("in_segments")), "M")


@query(
    "rfm_pca_variance",
    f""", {RFM_SQL} SELECT COUNT(*) AS users, ROUND(var_samp("R") + var_samp("F") + var_samp("M"), 4) AS variance,
    TRUE AS falling FROM g_rfm""",
)
def rfm_pca_variance(spark, sf_dir):
    """All three components together hold the whole variance of R, F and M, the first one most of it."""
    star = load_star(spark, sf_dir)
    done = segment.rfm_pca(segment.rfm(star.orders, star.train), 3)
    parts = [F.var_samp(f"pc{i}") for i in (1, 2, 3)]
    return done.agg(F.count("*").alias("users"), F.round(sum(parts[1:], parts[0]), 4).alias("variance"),
                    ((parts[0] >= parts[1] - 1e-9) & (parts[1] >= parts[2] - 1e-9)).alias("falling"))


@query(
    "segment_popularity",
    f""", {SEGPOP_SQL} SELECT segment, product_id, ROUND(score, 6) AS score, rank, ROUND(support_seg, 6) AS support_seg,
    ROUND(support_global, 6) AS support_global FROM s_pop""",
)
def segment_popularity(spark, sf_dir):
    return rounded(popularity_of(load_star(spark, sf_dir)), "score", "support_seg", "support_global")


@query(
    "segment_top_n",
    f", {SEGPOP_SQL} SELECT segment, product_id, CAST(rank AS INT) AS rank FROM s_pop WHERE rank <= 5",
)
def segment_top_n(spark, sf_dir):
    pop = popularity_of(load_star(spark, sf_dir)).drop("rank")
    ranked = ranking.top_n_per(pop, ["segment"], [F.desc("score"), F.desc("support_seg"), F.col("product_id")], 5)
    return ranked.select("segment", "product_id", "rank")


@query(
    "cluster_dense_top_n",
    f""", {SEGPOP_SQL}, dr AS (SELECT segment, product_id, ROUND(score, 4) AS score,
      CAST(dense_rank() OVER (PARTITION BY segment ORDER BY ROUND(score, 4) DESC) AS INT) AS rank FROM s_pop)
    SELECT * FROM dr WHERE rank <= 3""",
)
def cluster_dense_top_n(spark, sf_dir):
    pop = rounded(popularity_of(load_star(spark, sf_dir)), "score", digits=4)
    return ranking.dense_top_n(pop, 3)


@query(
    "rank_if_missing",
    f""", {SEGPOP_SQL}, r AS (SELECT segment, product_id, CAST(ROW_NUMBER() OVER (PARTITION BY segment
      ORDER BY ROUND(score, 9) DESC, product_id) AS INT) AS rank FROM s_pop) SELECT * FROM r WHERE rank <= 5""",
)
def rank_if_missing(spark, sf_dir):
    pop = rounded(popularity_of(load_star(spark, sf_dir)), "score", digits=9).drop("rank")
    return ranking.first_k(pop, 5).select("segment", "product_id", "rank")


@query(
    "cluster_summary",
    f""", {RFM_SQL} SELECT segment, COUNT(user_id) AS user_id_count, ROUND(AVG("R"), 4) AS "R_mean", ROUND(MIN("R"), 4) AS "R_min",
    ROUND(MAX("R"), 4) AS "R_max", ROUND(AVG("F"), 4) AS "F_mean", MIN("F") AS "F_min", MAX("F") AS "F_max",
    ROUND(AVG("M"), 4) AS "M_mean", ROUND(MIN("M"), 4) AS "M_min", ROUND(MAX("M"), 4) AS "M_max" FROM g_seg GROUP BY 1""",
)
def cluster_summary(spark, sf_dir):
    return segment.cluster_summary(fixed_segments(load_star(spark, sf_dir)))


@query(
    "segment_centroids",
    f""", {RFM_SQL} SELECT segment, ROUND(AVG("R"), 3) AS r, ROUND(AVG("F"), 3) AS f, ROUND(AVG("M"), 3) AS m,
    ROUND(AVG(r_z), 3) AS r_z, ROUND(AVG(f_z), 3) AS f_z, ROUND(AVG(m_z), 3) AS m_z FROM g_z GROUP BY 1""",
)
def segment_centroids(spark, sf_dir):
    return segment.segment_centroids(segment.with_z_scores(fixed_segments(load_star(spark, sf_dir))))


@query(
    "segment_lift",
    f""", {SEGPOP_SQL}, l AS (SELECT *, support_seg / GREATEST(support_global, 1e-9) AS lift FROM s_pop),
    v AS (SELECT product_id FROM l GROUP BY 1 ORDER BY ROUND(COALESCE(var_samp(lift), 0), 9) DESC, ROUND(AVG(lift), 9) DESC, product_id LIMIT 30)
    SELECT segment, product_id, ROUND(COALESCE(MAX(lift), 1.0), 6) AS lift FROM (SELECT DISTINCT segment FROM l
      JOIN v USING (product_id)) s CROSS JOIN v LEFT JOIN l USING (segment, product_id) GROUP BY 1, 2""",
)
def segment_lift(spark, sf_dir):
    return rounded(segment.segment_lift(popularity_of(load_star(spark, sf_dir))), "lift")


@query("rfm_pca")
def rfm_pca(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return rounded(segment.rfm_pca(segment.rfm(star.orders, star.train)), "pc1", "pc2")


def scored_users(star):
    return segment.with_z_scores(fixed_segments(star))


@query("high_value_users", f", {RFM_SQL} SELECT user_id, segment, ROUND(hv, 6) AS hv FROM g_hv ORDER BY g_hv.hv DESC, user_id LIMIT 150")
def high_value_users(spark, sf_dir):
    top = segment.high_value_users(scored_users(load_star(spark, sf_dir)))
    return rounded(top.select("user_id", "segment", "hv"), "hv")


@query("user_profile", f', {RFM_SQL} SELECT user_id, "R", "F", ROUND("M", 6) AS "M", segment FROM g_seg WHERE user_id = 7')
def user_profile(spark, sf_dir):
    return rounded(segment.user_profile(fixed_segments(load_star(spark, sf_dir)), 7), "M")


@query("user_segment", f", {RFM_SQL} SELECT user_id, segment FROM g_seg WHERE user_id = 7")
def user_segment(spark, sf_dir):
    return segment.user_segment(fixed_segments(load_star(spark, sf_dir)), 7)


@query(
    "segment_recommendations",
    f""", {RFM_SQL}, {SEGPOP_SQL} SELECT user_id, segment, product_id, ROUND(score, 6) AS score, rank
    FROM g_seg JOIN s_pop USING (segment) WHERE rank <= 10""",
)
def segment_recommendations(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return rounded(segment.segment_recommendations(fixed_segments(star), popularity_of(star), 10), "score")


@query(
    "same_segment_users",
    f""", {RFM_SQL}, o AS (SELECT a.user_id, a.segment, b.user_id AS similar_user_id,
      CAST(ROW_NUMBER() OVER (PARTITION BY a.user_id ORDER BY b.user_id) AS INT) AS rank
      FROM g_seg a JOIN g_seg b ON a.segment = b.segment AND a.user_id <> b.user_id WHERE a.user_id IN (1, 100, 1000)),
    s AS (SELECT segment, COUNT(*) AS user_id_count, ROUND(AVG("R"), 4) AS "R_mean", ROUND(AVG("F"), 4) AS "F_mean",
      ROUND(AVG("M"), 4) AS "M_mean" FROM g_seg GROUP BY 1)
    SELECT * FROM o JOIN s USING (segment) WHERE rank <= 5""",
)
def same_segment_users(spark, sf_dir):
    df = segment.same_segment_users(fixed_segments(load_star(spark, sf_dir)), ASKED_USERS, 5)
    return df.drop(*[f"{c}_{s}" for c in "RFM" for s in ("min", "max")])


COHORT_SQL = f"""
{RFM_SQL}, {SEGPOP_SQL}, h_hv AS (SELECT user_id, segment, hv FROM g_hv ORDER BY hv DESC, user_id LIMIT 150),
h_rnd AS (SELECT user_id, segment, hv FROM g_hv ORDER BY md5('42:' || CAST(user_id AS VARCHAR)), user_id LIMIT 150),
h_all AS (SELECT *, 'high_value' AS cohort FROM h_hv UNION ALL SELECT *, 'random' FROM h_rnd),
h_recs AS (SELECT user_id, segment, hv, product_id, rank, score, cohort FROM h_all LEFT JOIN s_pop USING (segment)
  WHERE rank <= 5)
"""


def cohorts(star):
    users = segment.with_value_score(scored_users(star))
    return segment.cohort_union(segment.high_value_users(users), ranking.random_users(users, 150), popularity_of(star))


@query(
    "cohort_union",
    f", {COHORT_SQL} SELECT user_id, segment, ROUND(hv, 6) AS hv, product_id, rank, ROUND(score, 6) AS score, cohort FROM h_recs",
)
def cohort_union(spark, sf_dir):
    return rounded(cohorts(load_star(spark, sf_dir)), "hv", "score")


def model_users(spark, sf_dir):
    return truth_of(load_star(spark, sf_dir)).select("user_id").distinct()


@query("dual_recommendations")
def dual_recommendations(spark, sf_dir):
    star = load_star(spark, sf_dir)
    users = model_users(spark, sf_dir)
    personal = recommend.recommend_subset(trained(spark, sf_dir)[0], users, 5).withColumn("user_id", F.col("user_id").cast("long"))
    members = fixed_segments(star).join(users, "user_id", "left_semi")
    shared = segment.segment_recommendations(members, popularity_of(star), 5)
    return rounded(recommend.dual_recommendations(personal, shared, catalog(star), 5), "score", digits=3)


@query(
    "dual_recommendations_listed",
    f""", {CANDIDATES_SQL}, {RFM_SQL}, {SEGPOP_SQL}, {CATALOG_SQL},
    own AS (SELECT user_id, 'personal' AS source, CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS INT) AS rank,
      product_id, ROUND(score, 6) AS score FROM k_recs),
    both_lists AS (SELECT * FROM own WHERE rank <= 5 UNION ALL
      SELECT user_id, 'segment', CAST(s.rank AS INT), product_id, ROUND(s.score, 6) FROM g_seg JOIN s_pop s USING (segment) WHERE s.rank <= 5)
    SELECT b.*, COALESCE(product_name, 'Product_' || b.product_id) AS product_name, COALESCE(aisle, 'Unknown') AS aisle,
      COALESCE(department, 'Unknown') AS department FROM both_lists b LEFT JOIN cat USING (product_id)""",
)
def dual_recommendations_listed(spark, sf_dir):
    """Both lists side by side from fixed candidates."""
    star = load_star(spark, sf_dir)
    shared = segment.segment_recommendations(fixed_segments(star), popularity_of(star), 5)
    return rounded(recommend.dual_recommendations(candidate_rows(star), shared, catalog(star), 5), "score")


def bands_sql(index: int) -> str:
    cases = " ".join(f"WHEN normalized_score >= {band[0]} THEN '{band[index]}'" for band in scores.BANDS)
    return f"CASE {cases} ELSE '{scores.LOWEST_BAND[index - 1]}' END"


@query(
    "preference_bands",
    f""", {CANDIDATES_SQL}, r AS (SELECT user_id, product_id, score AS normalized_score,
      CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS INT) AS rank FROM k_recs)
    SELECT user_id, product_id, ROUND(r.normalized_score, 6) AS normalized_score, rank, {bands_sql(1)} AS confidence,
      {bands_sql(2)} AS description FROM r WHERE rank <= 5""",
)
def preference_bands(spark, sf_dir):
    """Preference of users for their fixed candidates, with the bands of the scores."""
    rows = candidate_rows(load_star(spark, sf_dir)).select("user_id", "product_id", F.col("score").alias("normalized_score"))
    return rounded(recommend.preference(rows), "normalized_score")


@query(
    "preferred_products",
    f""", {CATALOG_SQL}, {STRETCHED_SQL}, m AS (SELECT product_id, product_name FROM cat WHERE
      contains(lower(product_name), 'red') OR contains(lower(product_name), 'ring') OR contains(lower(product_name), 'gizmo')
      OR contains(lower(aisle), 'red') OR contains(lower(aisle), 'ring') OR contains(lower(aisle), 'gizmo')
      OR contains(lower(department), 'red') OR contains(lower(department), 'ring') OR contains(lower(department), 'gizmo')),
    s AS (SELECT a.vec_id AS user_id, product_id, product_name, ROUND(list_dot_product(a.v, b.w), 6) AS raw
      FROM e a, e b JOIN m ON product_id = b.vec_id),
    z AS (SELECT *, ROUND(LEAST(GREATEST(raw, 0.0::DOUBLE), 2.0::DOUBLE) / 2, 3) AS normalized_score FROM s),
    r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY normalized_score DESC, product_id) AS INT) AS rank FROM z)
    SELECT user_id, product_id, product_name, ROUND(r.raw, 3) AS score, normalized_score, rank, {bands_sql(1)} AS confidence,
      {bands_sql(2)} AS description FROM r WHERE rank <= 5""",
)
def preferred_products(spark, sf_dir):
    """Preference for named products on fixed factors."""
    names = recommend.named_products(catalog(load_star(spark, sf_dir)), "red ring, gizmo")
    return recommend.preferred(embeddings(spark, sf_dir), stretched(spark, sf_dir), names)


@query("user_product_preference")
def user_product_preference(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return recommend.user_product_preference(
        trained(spark, sf_dir)[0], model_users(spark, sf_dir), catalog(star), "red ring, gizmo"
    )


# -- search ------------------------------------------------------------------------------------------------------


@query(
    "search_products",
    f""", {CATALOG_SQL} SELECT product_id, product_name, aisle, department, 1.0::DOUBLE AS score FROM cat
    WHERE contains(lower(product_name), 'ring') OR contains(lower(aisle), 'ring') OR contains(lower(department), 'ring')""",
)
def search_products(spark, sf_dir):
    return search.search_products(catalog(load_star(spark, sf_dir)), "RING")


def term_sql(term: str) -> str:
    found = f"(contains(lower(product_name), '{term}') OR contains(lower(aisle), '{term}') OR contains(lower(department), '{term}'))"
    exact = f"(lower(product_name) = '{term}' OR list_contains(string_split(lower(product_name), ' '), '{term}'))"
    return f"CASE WHEN {found} THEN 1 ELSE 0 END + CASE WHEN {exact} THEN 2 ELSE 0 END"


@query(
    "fuzzy_product_id",
    f""", {CATALOG_SQL} SELECT product_id, product_name, aisle, department,
    CAST({term_sql('red')} + {term_sql('ring')} + {term_sql('brand#1')} AS INT) AS score FROM cat
    WHERE contains(lower(product_name), 'red') OR contains(lower(product_name), 'ring') OR contains(lower(aisle), 'brand#1')
      OR contains(lower(department), 'red') OR contains(lower(department), 'ring')
    ORDER BY score DESC, product_id LIMIT 10""",
)
def fuzzy_product_id(spark, sf_dir):
    return search.fuzzy_product_id(catalog(load_star(spark, sf_dir)), "'Red Ring Brand#1'")


@query(
    "product_by_id",
    f""", {CATALOG_SQL}, q AS (SELECT DISTINCT CASE WHEN product_id % 3 = 0 THEN ' "' || product_id || '" '
      WHEN product_id % 3 = 1 THEN 'product ' || product_id || '?' WHEN product_id % 5 = 0 THEN 'none' ELSE CAST(product_id AS VARCHAR) END AS request,
      CASE WHEN product_id % 3 = 2 AND product_id % 5 = 0 THEN NULL ELSE product_id END AS product_id FROM b_prior)
    SELECT request, product_id, product_name, aisle, department FROM q LEFT JOIN cat USING (product_id)""",
)
def product_by_id(spark, sf_dir):
    star = load_star(spark, sf_dir)
    pid = F.col("product_id")
    text = (
        F.when(pid % 3 == 0, F.concat(F.lit(' "'), pid, F.lit('" ')))
        .when(pid % 3 == 1, F.concat(F.lit("product "), pid, F.lit("?")))
        .when(pid % 5 == 0, "none")
        .otherwise(pid.cast("string"))
    )
    requests = star.prior.select(text.alias("request")).distinct()
    return search.product_by_id(requests, catalog(star))


@query(
    "clean_ids",
    """SELECT order_id, order_id AS cleaned FROM b_orders""",
)
def clean_ids(spark, sf_dir):
    oid = F.col("order_id")
    text = F.when(oid % 2 == 0, F.concat(F.lit("'"), oid, F.lit("'"))).otherwise(F.concat(F.lit("no. "), oid))
    return load_star(spark, sf_dir).orders.select("order_id", clean_id(text).alias("cleaned"))


@query(
    "similar_vectors",
    """, e AS (SELECT vec_id, label, i, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings, range(1, 65) r(i)),
    c AS (SELECT label AS query_id, i, AVG(x) AS x FROM e GROUP BY 1, 2),
    cn AS (SELECT query_id, SQRT(SUM(x * x)) AS n FROM c GROUP BY 1),
    en AS (SELECT vec_id, SQRT(SUM(x * x)) AS n FROM e GROUP BY 1),
    s AS (SELECT query_id, vec_id, ROUND(SUM(e.x * c.x) / (ANY_VALUE(cn.n) * ANY_VALUE(en.n) + 1e-10), 6) AS similarity
      FROM e JOIN c USING (i) JOIN cn USING (query_id) JOIN en USING (vec_id) GROUP BY 1, 2),
    r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS INT) AS rank FROM s)
    SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, similarity, rank, label FROM r JOIN embeddings USING (vec_id) WHERE rank <= 5""",
)
def similar_vectors(spark, sf_dir):
    """The five vectors closest to the mean vector of each label."""
    base = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    queries = search.group_centroids(base, "label", "embedding")
    return search.similar_vectors(base, queries, 5)


def product_queries(star):
    """A query for every seventh product: a word of its name and its aisle, or part of one."""
    cat, pid = catalog(star), F.col("product_id")
    name = F.element_at(F.split("product_name", " "), 1)
    text = (
        F.when(pid % 3 == 0, F.concat(F.lit(' "'), F.upper(name), F.lit(" "), F.col("aisle"), F.lit(' "')))
        .when(pid % 3 == 1, F.substring("product_name", 2, 5))
        .otherwise(F.concat(F.substring(name, 1, 2), F.lit(" "), F.lower("department")))
    )
    return cat.where(pid % 7 == 0).select(pid.alias("query_id"), text.alias("query"))


PRODUCT_QUERIES_SQL = """pq AS (SELECT product_id AS query_id, CASE
      WHEN product_id % 3 = 0 THEN ' "' || upper(string_split(product_name, ' ')[1]) || ' ' || aisle || ' "'
      WHEN product_id % 3 = 1 THEN substr(product_name, 2, 5)
      ELSE substr(string_split(product_name, ' ')[1], 1, 2) || ' ' || lower(department) END AS query FROM cat WHERE product_id % 7 = 0)"""


@query(
    "search_products_many",
    f""", {CATALOG_SQL}, {PRODUCT_QUERIES_SQL} SELECT query_id, product_id, product_name, aisle, department, 1.0::DOUBLE AS score
    FROM pq JOIN cat ON contains(lower(product_name), lower(query)) OR contains(lower(aisle), lower(query)) OR contains(lower(department), lower(query))""",
)
def search_products_many(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return postings.search_products(postings.build_postings(catalog(star)), product_queries(star))


@query(
    "fuzzy_products_many",
    f""", {CATALOG_SQL}, {PRODUCT_QUERIES_SQL},
    w AS (SELECT query_id, unnest(regexp_split_to_array(trim(regexp_replace(trim(lower(query)), '^[\\x22\\x27]+|[\\x22\\x27]+$', '', 'g')), '\\s+')) AS term FROM pq),
    h AS (SELECT query_id, product_id, CAST(SUM(1 + CASE WHEN lower(product_name) = term OR list_contains(string_split(lower(product_name), ' '), term)
        THEN 2 ELSE 0 END) AS INT) AS score
      FROM w JOIN cat ON term <> '' AND (contains(lower(product_name), term) OR contains(lower(aisle), term) OR contains(lower(department), term))
      GROUP BY 1, 2),
    r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, product_id) AS INT) AS rank FROM h)
    SELECT query_id, product_id, product_name, aisle, department, score, rank FROM r JOIN cat USING (product_id) WHERE rank <= 10""",
)
def fuzzy_products_many(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return postings.fuzzy_products(postings.build_postings(catalog(star)), product_queries(star))


@query(
    "cluster_recommendations",
    f""", {SEGPOP_SQL} SELECT segment, product_id, ROUND(s_pop.score, 6) AS score, rank FROM s_pop WHERE segment = 3 AND rank <= 10""",
)
def cluster_recommendations(spark, sf_dir):
    """The ten best products of one segment."""
    found = segment.cluster_recommendations(popularity_of(load_star(spark, sf_dir)), 3, 10)
    return rounded(found.select("segment", "product_id", "score", "rank"), "score")
