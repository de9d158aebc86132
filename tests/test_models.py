from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartwheel.functions import scores
from cartwheel.operators import evaluate, features, impute, ranking, recommend, search, segment


# -- imputation --------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def users(spark):
    n = 3000
    rng = np.random.default_rng(1)
    freq = rng.integers(1, 40, n)
    days = np.clip(25 - 0.5 * freq + rng.normal(0, 3, n), 0, 29).astype(int)
    data = [(int(i), None if i % 5 == 0 else int(days[i]), int(freq[i])) for i in range(n)]
    return spark.createDataFrame(data, "user_id long, days_imp int, frequency int")


def test_pmm_keeps_observed_rows_and_draws_from_donors(users):
    out = users.join(impute.impute_pmm(users), "user_id").collect()
    assert len(out) == 3000
    observed = {r["days_imp"] for r in out if r["days_imp"] is not None}
    assert all(r["days_imp_imputed"] == r["days_imp"] for r in out if r["days_imp"] is not None)
    missing = [r for r in out if r["days_imp"] is None]
    assert len(missing) == 600
    assert all(min(observed) <= r["days_imp_imputed"] <= max(observed) for r in missing)


def test_pmm_single_chain_values_are_observed_values_near_the_prediction(users):
    out = users.join(impute.impute_pmm(users, chains=1), "user_id").collect()
    observed = {r["days_imp"] for r in out if r["days_imp"] is not None}
    assert {r["days_imp_imputed"] for r in out if r["days_imp"] is None} <= observed
    # The gap falls with the frequency; the imputed values must as well.
    x = [r["frequency"] for r in out if r["days_imp"] is None]
    y = [r["days_imp_imputed"] for r in out if r["days_imp"] is None]
    assert np.corrcoef(x, y)[0, 1] < -0.7


def test_pmm_is_repeatable_and_independent_of_partitioning(users):
    a = rows(impute.impute_pmm(users), "user_id")
    b = rows(impute.impute_pmm(users.repartition(3, "frequency")), "user_id")
    assert a == b
    assert a != rows(impute.impute_pmm(users, seed=7), "user_id")


def test_pmm_donor_is_among_the_nearest(spark):
    # Without noise the prediction is exact, so a donor comes from the 2 neighbours on either side.
    data = [(i, None if i % 10 == 5 else i, 1) for i in range(200)]
    df = spark.createDataFrame(data, "user_id long, days_imp int, frequency int")
    out = impute.impute_pmm(df, chains=1, donors=4).filter("user_id % 10 = 5").collect()
    assert len(out) == 20
    assert all(abs(r["days_imp_imputed"] - r["user_id"]) <= 4 for r in out)


@pytest.mark.parametrize("observed", [0, 1, 3])
def test_pmm_with_few_observed_rows(spark, observed):
    data = [(i, i if i < observed else None, 1 + i % 2) for i in range(10)]
    out = impute.impute_pmm(spark.createDataFrame(data, "user_id long, days_imp int, frequency int")).collect()
    assert len(out) == 10
    assert all((r["days_imp_imputed"] is None) == (observed == 0) for r in out)


def test_backfill_prefers_estimate_then_user_then_overall_median(spark):
    schema = "order_id long, user_id long, order_number int, days_since_prior_order int"
    orders = spark.createDataFrame(
        [(1, 1, 1, None), (2, 1, 2, 30), (3, 2, 1, None), (4, 2, 2, 8), (5, 2, 3, 30), (6, 3, 1, 30), (7, 4, 1, 30), (8, 4, 2, 5)],
        schema,
    )
    estimates = spark.createDataFrame([(1, 12)], "user_id long, days_imp_imputed int")
    out = dict(rows(impute.backfill_orders(orders, estimates).select("order_id", "days_since_prior_order")))
    # user 2: median of 0 and 8; user 3 has only the masked row: median of 0, 0, 8, 30, 5 overall; user 4: 30 is not last
    assert out == {1: 0, 2: 12, 3: 0, 4: 8, 5: 4, 6: 5, 7: 30, 8: 5}


def test_histogram_of_equal_values(spark):
    out = impute.interval_histogram(spark.createDataFrame([(70.0,), (80.0,)], "days double"), bins=10, x_max=60.0).collect()
    assert [(r["bin"], r["n"]) for r in out] == [(5, 2)]
    assert math.isclose(out[0]["density"], 10.0)


def test_ecdf_of_fractional_values_matches_sorting(spark):
    values = [0.2, 0.2, 0.7, 1.5, 3.0, 3.2, 59.9, 60.0, 61.0]
    out = rows(ranking.ecdf(spark.createDataFrame([(v,) for v in values], "v double"), "v"), "value")
    assert [r[0] for r in out] == sorted({v for v in values if v <= 60})
    for value, _, cdf in out:
        assert math.isclose(cdf, sum(v <= value for v in values) / len(values))


# -- evaluation --------------------------------------------------------------------------------------------------


def naive_metrics(rec, truth, k):
    rec = rec[:k]
    hits, precision_sum, dcg = 0, 0.0, 0.0
    for i, item in enumerate(rec):
        if item in truth:
            hits += 1
            precision_sum += hits / (i + 1)
            dcg += 1 / math.log2(i + 2)
    ideal = sum(1 / math.log2(i + 2) for i in range(min(len(truth), k)))
    return hits, hits / k, hits / len(truth), precision_sum / hits if hits else 0.0, dcg / ideal


def test_ranking_metrics_match_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    recs = {u: [int(x) for x in rng.permutation(40)[: rng.integers(0, 16)]] for u in range(50)}
    truth = {u: {int(x) for x in rng.permutation(40)[: rng.integers(1, 20)]} for u in range(5, 60)}
    rec_df = spark.createDataFrame(list(recs.items()), "user_id long, rec_items array<bigint>")
    truth_df = spark.createDataFrame([(u, p) for u, t in truth.items() for p in t], "user_id long, product_id long")
    out = evaluate.ranking_metrics(rec_df, truth_df, 10).collect()
    assert {r["user_id"] for r in out} == set(recs) & set(truth)
    for r in out:
        want = naive_metrics(recs[r["user_id"]], truth[r["user_id"]], 10)
        got = (r["hits"], r["precision"], r["recall"], r["ap_hits"], r["ndcg"])
        assert np.allclose(got, want), r
        assert all(0 <= v <= 1 for v in got[1:])


def test_baseline_of_no_lines_is_minus_one(spark):
    truth = spark.createDataFrame([(1, 5)], "user_id long, product_id long")
    lines = spark.createDataFrame([], "order_id long, product_id long")
    assert rows(evaluate.popularity_baseline(lines, truth, 3)) == [(1, [-1])]


def test_lift_without_base_is_null(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 0.0), (2.0, None)], "a double, b double")
    assert rows(df.select(scores.lift(F.col("a"), F.col("b")))) == [(1.0,), (None,), (None,)]


# -- re-ranking --------------------------------------------------------------------------------------------------


def naive_mmr(items, base, vectors, k, lam):
    def cosine(a, b):
        if a is None or b is None:
            return 0.0
        na, nb = np.linalg.norm(a), np.linalg.norm(b)
        return max(0.0, float(a @ b / (na * nb))) if na and nb else 0.0

    pool, chosen = list(range(len(items))), []
    while pool and len(chosen) < k:
        def value(i):
            if not chosen:
                return base[i]
            return lam * base[i] - (1 - lam) * max(cosine(vectors[i], vectors[j]) for j in chosen)

        best = max(pool, key=lambda i: (value(i), -i))
        chosen.append(best)
        pool.remove(best)
    return [items[i] for i in chosen + pool]


@pytest.fixture(scope="module")
def pools(spark):
    rng = np.random.default_rng(5)
    vectors = {p: (None if p % 9 == 0 else rng.normal(size=6)) for p in range(40)}
    cand = {u: [(pos, int(p), float(rng.normal())) for pos, p in enumerate(rng.permutation(40)[:12])] for u in range(30)}
    recs = spark.createDataFrame(
        [(u, pos, p, s) for u, c in cand.items() for pos, p, s in c], "user_id long, pos int, product_id long, base double"
    )
    known = [(p, [float(x) for x in v]) for p, v in vectors.items() if v is not None]
    return cand, vectors, recs, spark.createDataFrame(known, "product_id long, vector array<float>")


@pytest.mark.parametrize("lam", [0.0, 0.3, 0.9])
def test_mmr_matches_the_plain_greedy_loop(pools, lam):
    cand, vectors, recs, vector_df = pools
    out = dict(rows(recommend.mmr(recs, vector_df, lam=lam, k=8)))
    exact = {p: None if v is None else np.float32(v).astype(float) for p, v in vectors.items()}
    for u, c in cand.items():
        items = [p for _, p, _ in c]
        want = naive_mmr(items, [s for _, _, s in c], [exact[p] for p in items], 8, lam)
        assert list(out[u]) == want


def test_mmr_with_lambda_one_is_score_order(pools):
    cand, _, recs, vector_df = pools
    out = dict(rows(recommend.mmr(recs, vector_df, lam=1.0, k=12)))
    for u, c in cand.items():
        assert list(out[u]) == [p for _, p, s in sorted(c, key=lambda x: -x[2])]


def test_backfill_edges(spark):
    lists = spark.createDataFrame([(1, [5, 5, 7]), (2, []), (3, None), (4, list(range(20)))], "user_id long, rec_items array<bigint>")
    top = F.array(*[F.lit(x).cast("long") for x in (7, 8, 9)])
    assert dict(rows(recommend.backfill(lists, top, 4))) == {1: [5, 7, 8, 9], 2: [], 3: [], 4: [0, 1, 2, 3]}


def test_flat_scores_blend_to_popularity_order(spark):
    recs = spark.createDataFrame([(1, i, p, 0.25) for i, p in enumerate((3, 1, 2))], "user_id long, pos int, product_id long, score double")
    pop = spark.createDataFrame([(2, 1.5)], "product_id long, pop_z double")
    out = rows(recommend.blend(recs, pop).select("product_id", "base", "rank"), "rank")
    assert [r[0] for r in out] == [2, 1, 3]
    assert [r[1] for r in out] == pytest.approx([0.45, 0.0, 0.0])


def test_unseen_users_keep_all_candidates(spark):
    recs = spark.createDataFrame([(1, 0, 5, 1.0), (2, 0, 5, 1.0)], "user_id long, pos int, product_id long, score double")
    seen = spark.createDataFrame([(1, 5)], "user_id long, product_id long")
    assert [r["user_id"] for r in recommend.filter_seen(recs, seen).collect()] == [2]


def test_popularity_z_without_spread_is_zero(spark):
    lines = spark.createDataFrame([(1,), (2,)], "product_id long")
    assert {r["pop_z"] for r in recommend.popularity_z(lines).collect()} == {0.0}


def test_normalisation_bounds(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (1.0,), (5.0,), (None,)], "s double")
    out = [r[0] for r in df.select(scores.normalize(F.col("s"))).collect()]
    assert out == [0.0, 0.0, 0.5, 1.0, None]


# -- training ----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark, star):
    return recommend.train_als(features.ratings(star.prior, star.orders), rank=4, iters=2)[0]


def test_training_rejects_bad_ratings(spark):
    empty = spark.createDataFrame([], "user_id int, product_id int, rating double")
    with pytest.raises(ValueError, match="no ratings"):
        recommend.train_als(empty)
    zero = spark.createDataFrame([(1, 1, 0.0)], "user_id int, product_id int, rating double")
    with pytest.raises(ValueError, match="positive"):
        recommend.train_als(zero)


def test_ratings_are_deduplicated_by_the_highest(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 1, 3.0), (1, 2, 2.0)], "user_id int, product_id int, rating double")
    assert rows(features.dedupe_ratings(df), "product_id") == [(1, 1, 3.0), (1, 2, 2.0)]


def test_recommendations(spark, model):
    lists = recommend.recommend_all(model, 5).collect()
    assert all(len(set(r["rec_items"])) == 5 for r in lists)
    assert len(lists) == model.users.count()


def test_unknown_pairs_score_zero(spark, model):
    known = model.users.first()["user_id"]
    pairs = spark.createDataFrame([(known, 10**6), (10**6, 1)], "user_id long, product_id long")
    assert [(r["score"], r["normalized_score"]) for r in recommend.score_pairs(model, pairs).collect()] == [(0.0, 0.0)] * 2


def test_similar_users_leave_the_user_out(spark, model):
    users = model.users.limit(3).select("user_id")
    out = recommend.similar_users(recommend.user_vectors(model), users, 4).collect()
    assert len(out) == 12
    assert all(r["user_id"] != r["similar_user_id"] for r in out)


# -- vectors -----------------------------------------------------------------------------------------------------


def test_ids_beyond_32_bits_and_a_saved_model(spark, tmp_path):
    big = 1 << 40
    rows_in = [(big + u, 3 * big + p, 1.0 + (u * p) % 3) for u in range(20) for p in range(12) if (u + p) % 3]
    ratings = spark.createDataFrame(rows_in, "user_id long, product_id long, rating double")
    model, meta = recommend.train_als(ratings, rank=4, iters=2, blocks=2)
    lists = recommend.all_candidates(model, 5)
    found = rows(lists, "user_id", "pos")
    assert {r[0] for r in found} == {big + u for u in range(20)} and {r[2] for r in found} <= {3 * big + p for p in range(12)}
    recommend.save_model(model, meta, str(tmp_path / "m"))
    again, meta_again = recommend.load_model(spark, str(tmp_path / "m"))
    assert rows(recommend.all_candidates(again, 5), "user_id", "pos") == found and meta_again == meta
    pairs = spark.createDataFrame([(big, 3 * big + 1), (big, 5), (9, 3 * big)], "user_id long, product_id long")
    scored = {tuple(r[:2]): r[2] for r in rows(recommend.score_pairs(again, pairs), "user_id")}
    assert scored[9, 3 * big] == scored[big, 5] == 0.0 and len(scored) == 3


@pytest.mark.parametrize("block", [1000, 4])
def test_nearest_matches_brute_force(spark, block):
    rng = np.random.default_rng(9)
    base = {i: rng.normal(size=5).astype(np.float32) for i in range(300)}
    base[300] = np.zeros(5, dtype=np.float32)
    asked = {i: rng.normal(size=5).astype(np.float32) for i in range(13)}
    schema = "id long, vector array<float>"
    base_df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in base.items()], schema).repartition(5)
    asked_df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in asked.items()], schema)
    out = rows(search.nearest(base_df, asked_df, 7, block=block).select("query_id", "rank", "id"), "query_id", "rank")
    for q, v in asked.items():
        sim = {i: round(float(v.astype(float) @ b.astype(float) / (np.linalg.norm(v.astype(float)) * np.linalg.norm(b.astype(float)) + 1e-10)), 6) for i, b in base.items()}
        want = sorted(sim, key=lambda i: (-sim[i], i))[:7]
        assert [r[2] for r in out if r[0] == q] == want


def test_nearest_without_queries(spark):
    base = spark.createDataFrame([(1, [1.0])], "id long, vector array<float>")
    assert search.nearest(base, base.limit(0), 3).count() == 0


def test_word_matches_take_each_product_once(spark):
    catalog = spark.createDataFrame(
        [(1, "red ring", "a", "d"), (2, "ring", "a", "d"), (3, "red", "a", "d"), (4, "blue", "red aisle", "d")],
        "product_id long, product_name string, aisle string, department string",
    )
    assert rows(search.word_matches(catalog, ["ring", "red"]), "product_id") == [(1, "red ring"), (2, "ring"), (3, "red"), (4, "blue")]
    # Only the first match of each word counts: product 1 for both words.
    assert rows(search.word_matches(catalog, ["ring", "red"], per_word=1)) == [(1, "red ring")]


def test_fuzzy_score(spark):
    catalog = spark.createDataFrame(
        [(1, "red ring", "ring", "d"), (2, "string", None, "d"), (3, "blue", "a", "d")],
        "product_id long, product_name string, aisle string, department string",
    )
    out = rows(search.fuzzy_product_id(catalog, ' "Ring" ').select("product_id", "score"))
    assert out == [(1, 3), (2, 1)]
    with pytest.raises(ValueError, match="no words"):
        search.fuzzy_product_id(catalog, "''")


# -- segments ----------------------------------------------------------------------------------------------------


def test_segments_are_repeatable_and_complete(spark, star):
    users = segment.rfm(star.orders, star.train)
    a = rows(segment.segment_users(users, k=4), "user_id")
    assert a == rows(segment.segment_users(users, k=4), "user_id")
    assert len(a) == users.count()
    assert {r[4] for r in a} <= set(range(4))


def test_one_user_has_no_segment(spark):
    one = spark.createDataFrame([(1, 1.0, 2, 1.0)], "user_id long, R double, F long, M double")
    assert segment.segment_users(one).count() == 0


def test_rfm_defaults(spark):
    orders = spark.createDataFrame(
        [(1, 1, 1, None), (2, 2, 1, None), (3, 2, 2, 90)], "order_id long, user_id long, order_number int, days_since_prior_order int"
    )
    train = spark.createDataFrame([(3, 1), (3, 2)], "order_id long, product_id long")
    assert rows(segment.rfm(orders, train), "user_id") == [(1, 0.0, 1, 1.0), (2, 60.0, 2, 2.0)]


def test_pca_keeps_variance_order(spark, star):
    out = segment.rfm_pca(segment.rfm(star.orders, star.train))
    var1, var2 = out.agg(F.var_samp("pc1"), F.var_samp("pc2")).first()
    assert var1 >= var2 > 0


def test_same_segment_users_leave_out_the_asked_user(spark):
    users = spark.createDataFrame(
        [(i, 1.0, 1, 1.0, i % 2) for i in range(10)], "user_id long, R double, F long, M double, segment int"
    )
    out = segment.same_segment_users(users, [0, 9], 3)
    got = rows(out.select("user_id", "similar_user_id", "user_id_count"), "user_id", "similar_user_id")
    assert got == [(0, 2, 5), (0, 4, 5), (0, 6, 5), (9, 1, 5), (9, 3, 5), (9, 5, 5)]


def test_nearest_donors_against_loops(spark):
    import numpy as np

    rng = np.random.default_rng(6)
    data = [(i, int(i % 9) if rng.random() < 0.5 else None, c, float(rng.integers(0, 40))) for c in (0, 1) for i in range(200)]
    data += [(900, None, 2, 1.0), (901, None, 0, None), (902, 4, 0, None), (903, None, 3, 5.0), (904, 7, 3, 5.0)]
    frame = spark.createDataFrame(data, "user_id long, days_imp int, chain int, predicted double").repartition(7)
    got = {(r.user_id, r.chain): [tuple(d) for d in r.donors] for r in impute.nearest_donors(frame, 3).collect()}
    want = {}
    for user, days, chain, at in data:
        if days is None and at is not None:
            given = [(u, d, p) for u, d, c, p in data if c == chain and d is not None and p is not None]
            pool = sorted((abs(p - at), (p, u) > (at, user), u if (p, u) > (at, user) else -u, u, d) for u, d, p in given)[:3]
            if pool:
                want[user, chain] = [x[3:] for x in pool]
    assert got == want and (900, 2) not in got and got[903, 3] == [(904, 7)]


def test_nearest_donors_meet_lists_and_not_places(spark):
    # Few complete rows far apart, so that many rows ask in one block, at its edges and beyond the last one.
    data = [(i, 1 + i % 5 if i % 13 == 4 else None, 0, float(i)) for i in range(300)]
    frame = spark.createDataFrame(data, "user_id long, days_imp int, chain int, predicted double").repartition(5)
    for n in (1, 4):
        found = impute.nearest_donors(frame, n)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        joins_at = [line for line in plan.splitlines() if "Join" in line and "place" in line]
        assert not joins_at and plan.count("Generate explode(") == 1
        got = {r.user_id: [d.user_id for d in r.donors] for r in found.collect()}
        given = [u for u, d, *_ in data if d is not None]
        want = {u: sorted(given, key=lambda g: (abs(g - u), g > u))[:n] for u, d, *_ in data if d is None}
        assert got == want


def test_rows_that_share_user_and_chain_share_donors(spark):
    data = [(1, None, 0, 1.0), (1, None, 0, 9.0), (2, 5, 0, 1.5), (3, 6, 0, 8.0), (4, 7, 0, 20.0), (None, None, 0, 19.0)]
    frame = spark.createDataFrame(data, "user_id long, days_imp int, chain int, predicted double")
    got = {r.user_id: [d.user_id for d in r.donors] for r in impute.nearest_donors(frame, 2).collect()}
    assert got == {1: [2, 3], None: [4, 3]}


def test_training_drops_shuffle_files_in_every_iteration(spark, monkeypatch):
    seen, fit = [], recommend.ALS.fit
    monkeypatch.setattr(recommend.ALS, "fit", lambda self, data: seen.append(self.getCheckpointInterval()) or fit(self, data))
    ratings = spark.createDataFrame([(u, i, 1.0 + u % 2) for u in range(4) for i in range(3)], "user_id long, product_id long, rating double")
    recommend.train_als(ratings, rank=2, iters=2, blocks=2)
    assert seen == [1]


def test_hits_come_text_by_text_and_product_by_product(spark):
    """Rows are written in this order; with texts and products mixed, files of many queries took twice the bytes."""
    from cartwheel.operators import postings

    catalog = spark.range(40).selectExpr("id AS product_id", "concat('blue lace ', id) AS product_name", "'a' AS aisle", "'d' AS department")
    queries = spark.range(60).selectExpr("id AS query_id", "if(id % 3 = 0, 'blue', if(id % 2 = 0, 'LACE', 'lace')) AS query")
    found = postings.search_products(postings.build_postings(catalog), queries)
    got = [(r.query_id % 3 > 0, r.product_id, r.query_id) for r in found.select("query_id", "product_id").collect()]
    assert sorted((q, p) for _, p, q in got) == [(q, p) for q in range(60) for p in range(40)]
    pairs = [g[:2] for g, before in zip(got, [(None, None), *got]) if g[:2] != before[:2]]
    assert len(pairs) == 2 * 40
    # One file for each shuffle partition at most, each in order.
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(y < x for x, y in zip(pairs, pairs[1:])) < files


def test_postings_find_what_a_scan_finds(spark):
    from cartwheel.operators import postings

    names = ["Red Ring", "ring", "RINGO star", None, "a", "é clair", "red", "it's 50% off"]
    data = [(i, n, f"Brand#{i % 3}", None if i == 2 else "toys") for i, n in enumerate(names)]
    catalog = spark.createDataFrame(data, "product_id long, product_name string, aisle string, department string")
    index = postings.build_postings(catalog)
    asked = ["ring", "RED", "a", "é", "50%", "brand#1", "", None, "nowhere", "red ring", "' red red ring'", "toys", "zz a", "it's"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id long, query string")
    exact = {(r.query_id, r.product_id) for r in postings.search_products(index, queries).collect()}
    fuzzy = {}
    for r in postings.fuzzy_products(index, queries, 4).collect():
        fuzzy.setdefault(r.query_id, []).append((r["rank"], r.product_id, r.score))
    for i, q in enumerate(asked):
        whole = {r.product_id for r in search.search_products(catalog, q).collect()} if q else set()
        assert {p for j, p in exact if j == i} == whole, q
        want = [(r.product_id, r.score) for r in search.fuzzy_product_id(catalog, q, 4).collect()] if q and q.strip("' ") else []
        assert [x[1:] for x in sorted(fuzzy.get(i, []))] == want, q
    assert len(postings.search_products(index, queries, 1).where("query_id = 11").collect()) == 1


def test_rank_if_missing_numbers_by_score(spark):
    from cartwheel.operators import ranking

    data = [(1, i, float(i % 4) if i % 5 else None) for i in range(60)] + [(None, 7, 2.0), (2, 1, None)]
    df = spark.createDataFrame(data, "segment int, product_id long, score double").repartition(5)
    got = {(r.segment, r.product_id): r["rank"] for r in ranking.rank_if_missing(df).collect()}
    want = {}
    for s in (1, 2, None):
        part = sorted((r for r in data if r[0] == s), key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))
        want.update({(s, r[1]): i + 1 for i, r in enumerate(part)})
    assert got == want
    assert ranking.rank_if_missing(df.drop("score")).columns == ["segment", "product_id"]


def test_queries_of_the_same_words_are_answered_once(spark):
    from cartwheel.operators import postings

    products = spark.createDataFrame(
        [(i, f"{('red', 'blue', 'dark red')[i % 3]} ring {i % 5}", f"aisle{i % 4}", None if i % 7 == 0 else "dep") for i in range(60)],
        "product_id long, product_name string, aisle string, department string",
    )
    asked = spark.createDataFrame(
        [(1, "red ring"), (2, "' RING  red'"), (3, "red red"), (4, "red"), (8, "red"), (8, "red"), (5, " "), (6, None), (7, "aisle1 blue dep")], "query_id long, query string"
    )
    found = postings.fuzzy_products(postings.build_postings(products), asked, 5)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.product_id, r.score))
    # Rows of one query_id are one query.
    assert got[1] == got[2] and got[3] == got[8] == [(n, i, 2 * s) for n, i, s in got[4]] and set(got) == {1, 2, 3, 4, 7, 8}
    want = []
    for i in range(60):
        name, fields = f"{('red', 'blue', 'dark red')[i % 3]} ring {i % 5}", (f"aisle{i % 4}", "" if i % 7 == 0 else "dep")
        score = sum((w in name or any(w in f for f in fields)) + 2 * (w in name.split()) for w in ("aisle1", "blue", "dep"))
        want += [(-score, i)] if score else []
    assert [(i, s) for _, i, s in got[7]] == [(i, -s) for s, i in sorted(want)[:5]]
    # Sums are taken by set of words, over a fixed number of partitions.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [words" in plan


def test_training_blocks_grow_with_the_ratings(spark, monkeypatch):
    assert recommend.training_blocks(540_000, 15_000, 20_000, 64, 8) == (10, 10)
    assert recommend.training_blocks(540_000, 15_000, 20_000, 64, 12) == (12, 12)
    # Six times the largest input that went through with ten blocks.
    users, products = recommend.training_blocks(194_000_000, 5_400_000, 7_200_000, 64, 6)
    assert 100 < users < 250 and 100 < products < 250
    # A task never gets more blocks than there are users or products.
    assert recommend.training_blocks(10**9, 3, 10**8, 64, 4)[0] == 10
    monkeypatch.setattr(recommend, "FACTOR_BYTES", 500)
    ratings = spark.range(600).selectExpr("id % 60 AS user_id", "id * 7 % 50 AS product_id", "1.0 + id % 3 AS rating")
    model = recommend.train_als(ratings, rank=2, iters=1)[0].model
    parts = [f.rdd.getNumPartitions() for f in (model.userFactors, model.itemFactors)]
    assert parts == list(recommend.training_blocks(300, 60, 50, 2, 8)) and min(parts) > 10
    assert (model.userFactors.count(), model.itemFactors.count()) == (60, 50)
