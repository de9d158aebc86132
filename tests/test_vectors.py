"""Index search and inner products against plain numpy, with ties, zero vectors, repeated and clustered vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from cartwheel.operators import recommend, vectors


def frame(spark, rows, ids=None):
    ids = range(len(rows)) if ids is None else ids
    data = [(int(i), None if r is None else [float(x) for x in r]) for i, r in zip(ids, rows)]
    return spark.createDataFrame(data, "id long, vector array<double>").repartition(3)


def plain_nearest(base, query, k, skip=None):
    norms = np.linalg.norm(base, axis=1) * np.linalg.norm(query) + 1e-10
    similar = np.round(base @ query / norms, 6)
    order = [i for i in np.lexsort((np.arange(len(base)), -similar)) if i != skip][:k]
    return [(int(i), float(similar[i]) + 0.0) for i in order]


def clustered(n, groups=12, d=16, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, d))
    return centres[rng.integers(0, groups, n)] + 0.08 * rng.normal(size=(n, d))


@pytest.mark.parametrize("exclude", [False, True])
def test_exact_on_clusters_with_few_visits(spark, exclude):
    rows = clustered(900)
    rows[5] = 0
    rows[7] = rows[8]
    index = vectors.build_index(frame(spark, rows), block=64)
    asked = [0, 5, 7, 8, 300, 899]
    done = vectors.search(index, frame(spark, rows[asked], asked), 6, exclude)
    got = {}
    for r in done.found.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id, r.similarity + 0.0))
    for q in asked:
        assert [x[1:] for x in sorted(got[q])] == plain_nearest(rows, rows[q], 6, q if exclude else None), q
    shares = done.shares().first()
    # The query without direction visits every cluster; the others a part of them.
    assert shares.n_vectors == 900 and shares.codes_share < 0.5 and shares.vectors_share < 0.3


def test_index_edges(spark):
    empty = frame(spark, [])
    index = vectors.build_index(empty)
    assert vectors.search(index, frame(spark, [[1.0, 0.0]]), 3).found.count() == 0
    few = vectors.build_index(frame(spark, [[1, 0], None, [0, 1]]))
    got = vectors.search(few, frame(spark, [[1, 1], None]), 5).found.orderBy("rank").collect()
    assert [(r.query_id, r.id) for r in got] == [(0, 0), (0, 2)]
    assert vectors.search(few, empty, 5).found.count() == 0
    twice = vectors.build_index(frame(spark, [[1, 0], [0, 1]], [4, 4]))
    got = vectors.search(twice, frame(spark, [[1, 0]]), 5).found.orderBy("rank").collect()
    assert [(r.id, r.similarity) for r in got] == [(4, 1.0), (4, 0.0)]


def test_products_exact_and_pruned(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(3000, 8)) * np.exp(rng.normal(size=(3000, 1)))
    base[10:14] = base[9]
    users = rng.normal(size=(40, 8))
    users[3] = 0
    done = vectors.largest_products(frame(spark, base), frame(spark, users), 5, block=100)
    got = {}
    for r in done.found.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id, r.score + 0.0))
    for u in range(40):
        score = np.round(base @ users[u], 6)
        want = np.lexsort((np.arange(3000), -score))[:5]
        assert [x[1:] for x in sorted(got[u])] == [(int(i), float(score[i]) + 0.0) for i in want]
    shares = done.shares.first()
    assert shares.pairs == 120_000 and shares.share < 0.4
    assert vectors.largest_products(frame(spark, []), frame(spark, users), 5).found.count() == 0


def test_preferred_ranks_by_the_clamped_score(spark):
    items = frame(spark, [[0.5], [3.0], [9.0], [-1.0], [2.0004]], [10, 11, 12, 13, 14])
    names = spark.createDataFrame([(i, f"p{i}") for i in (10, 11, 12, 13, 14, 15)], "product_id long, product_name string")
    got = recommend.preferred(frame(spark, [[1.0], [-1.0]]), items, names, 3).orderBy("user_id", "rank").collect()
    # Above 2 all are alike, so the smaller number comes first; below 0 likewise.
    assert [(r.user_id, r.product_id, r.normalized_score) for r in got] == [
        (0, 11, 1.0), (0, 12, 1.0), (0, 14, 1.0), (1, 13, 0.5), (1, 10, 0.0), (1, 11, 0.0),
    ]
    assert got[0].confidence == "VERY_HIGH" and got[3].description == "High preference/popularity"


def test_products_meet_without_shuffling_vectors(spark):
    rng = np.random.default_rng(3)
    base, users = rng.normal(size=(700, 6)) * 1.5 ** rng.integers(0, 12, size=(700, 1)), rng.normal(size=(90, 6))
    base[:300] = base[300:600]
    done = vectors.largest_products(frame(spark, base), frame(spark, users), 7, block=16)
    plan = done.found._jdf.queryExecution().executedPlan().toString()
    # Only the best rows of each query are shuffled, and no side is sent to the driver.
    assert plan.count("Exchange ") == 1 and "BroadcastExchange" not in plan
    got = {(r.query_id, r["rank"]): (r.id, r.score) for r in done.found.collect()}
    score = np.round(users @ base.T, 6)
    for u in range(90):
        want = np.lexsort((np.arange(700), -score[u]))[:7]
        assert [got[u, i + 1] for i in range(7)] == [(int(x), float(score[u, x])) for x in want]
    shares = done.shares.first()
    assert shares.pairs == 63_000 and shares.share < 0.7


def test_products_by_a_key_with_many_ties(spark):
    rng = np.random.default_rng(4)
    base, users = rng.normal(size=(5000, 3)), rng.normal(size=(30, 3))
    found = vectors.largest_products(frame(spark, base), frame(spark, users), 4, lambda x: np.clip(np.round(x), 0, 1), block=50).found
    got = {(r.query_id, r["rank"]): r.id for r in found.collect()}
    key = np.clip(np.round(np.round(users @ base.T, 6)), 0, 1)
    for u in range(30):
        assert [got[u, i + 1] for i in range(4)] == np.lexsort((np.arange(5000), -key[u]))[:4].tolist()


def test_rows_of_one_query_id_are_one_query(spark):
    base = [[5.0], [4.0], [3.0], [2.0], [1.0]]
    found = vectors.largest_products(frame(spark, base), frame(spark, [[1.0], [1.0], [2.0]], [7, 7, 8]), 5, block=1)
    got = {}
    for r in found.found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    assert got == {7: [0, 0, 0, 0, 1], 8: [0, 1, 2, 3, 4]}
    assert found.shares.first().pairs == 15


def plain_products(base, asked, k, key):
    score = np.round(asked @ base.T, 6)
    rank = key(score)
    best = [np.lexsort((np.arange(len(base)), -r))[:k] for r in rank]
    return [(q, int(i), float(score[q, i]) + 0.0) for q, places in enumerate(best) for i in places]


def met_in_blocks(base, asked, k, key, size=300):
    best = vectors._Best(k, key, np.arange(len(asked)), np.c_[np.full(len(asked), -np.inf), asked])
    for at in range(0, len(base), size):
        best.add(np.arange(at, min(at + size, len(base))), base[at : at + size])
    rows = best.rows().to_pydict()
    found = sorted(zip(rows["query_id"], -np.array(rows["key"]), rows["id"], rows["score"]))
    return [(q, i, s + 0.0) for q, _, i, s in found]


def steps(x):
    return np.round((np.clip(x, 0, 2)) / 2, 3)


@pytest.mark.parametrize("key", [vectors._same, steps, lambda x: np.floor(x), lambda x: np.zeros_like(x)])
@pytest.mark.parametrize("scale", [1e-3, 1.0, 300.0])
def test_products_of_32_bits_leave_the_best_of_64(key, scale):
    rng = np.random.default_rng(4)
    base, asked = rng.normal(size=(2000, 24)) * scale, rng.normal(size=(37, 24))
    base[500:900] = base[100:500]
    # Products that differ by less than 32 bits can tell.
    base[1200:1300] = base[1100:1200] * (1 + 3e-8)
    base[7] = asked[3] = 0
    assert met_in_blocks(base, asked, 6, key) == plain_products(base, asked, 6, key)


def test_vectors_beyond_32_bits():
    rng = np.random.default_rng(5)
    base, asked = np.round(rng.normal(size=(900, 8)), 2) * 2.0**140, np.round(rng.normal(size=(20, 8)), 2)
    best = vectors._Best(4, vectors._same, np.arange(20), np.c_[np.full(20, -np.inf), asked])
    for at in (0, 300, 600):
        best.add(np.arange(at, at + 300), base[at : at + 300])
    rows = best.rows().to_pydict()
    top = np.sort(asked @ base.T, axis=1)[:, -4:]
    assert all(np.isclose(sorted(s for q, s in zip(rows["query_id"], rows["score"]) if q == i), top[i]).all() for i in range(20))


def test_a_row_that_is_no_number_hides_no_other():
    rng = np.random.default_rng(6)
    base, asked = rng.normal(size=(600, 8)), rng.normal(size=(20, 8))
    base[450] = np.nan
    kept = np.r_[np.arange(450), np.arange(451, 600)]
    wanted = [(q, int(kept[i]), s) for q, i, s in plain_products(base[kept], asked, 3, vectors._same)]
    assert met_in_blocks(base, asked, 3, vectors._same) == wanted


def test_keys_are_taken_of_few_products():
    """Behind the first blocks hardly any product is among the best; keys of all would cost more than the products."""
    rng, taken = np.random.default_rng(7), []

    def key(x):
        taken.append(np.size(x))
        return steps(x)

    base, asked = rng.normal(size=(40_000, 16)), rng.normal(size=(256, 16))
    found = met_in_blocks(base, asked, 5, key, 2000)
    assert sum(taken) < base.shape[0] * asked.shape[0] / 4
    assert found == plain_products(base, asked, 5, steps)


def test_rows_between_bounds_are_left_out_only_where_no_query_reaches_them(monkeypatch):
    rng = np.random.default_rng(11)
    # Few directions, so that boxes are narrow, with rows of equal products, infinite ones and some that are no number.
    base = np.zeros((4000, 12))
    at = np.sort(rng.integers(0, 12, 4000))
    base[np.arange(4000), at] = rng.choice([-1.0, 1.0], 4000) * np.round(rng.uniform(0.5, 1.0, 4000), 2)
    base[:, 0] += 1e-3 * rng.normal(size=4000)
    asked = np.abs(rng.normal(size=(50, 12))) * (rng.random((50, 12)) < 0.2)
    asked[:5] = rng.normal(size=(5, 12))
    met = []
    add = vectors._Best.add
    monkeypatch.setattr(vectors._Best, "add", lambda self, names, base, rows=None: met.append(len(base) * (50 if rows is None else len(rows))) or add(self, names, base, rows))
    for k, key in ((3, vectors._same), (4, lambda x: np.clip(np.round(x, 1), 0, 0.8))):
        met.clear()
        best = vectors._Best(k, key, np.arange(50), np.c_[np.full(50, -np.inf), asked])
        ids = rng.permutation(4000)
        for i in range(0, 4000, 1000):
            part = slice(i, i + 1000)
            boxes = [f(base[part][j : j + vectors.BOXED], axis=0) for j in range(0, 1000, vectors.BOXED) for f in (np.min, np.max)]
            best.add_block(ids[part], base[part], np.array(boxes).reshape(-1, 2, 12))
        rows = best.rows().to_pylist()
        score = np.round(asked @ base.T, 6)
        rank = key(score)
        for u in range(50):
            want = np.lexsort((ids, -rank[u]))[:k]
            mine = sorted((-r["key"], r["id"]) for r in rows if r["query_id"] == u)
            assert mine == [(-float(rank[u, x]), int(ids[x])) for x in want]
        assert sum(met) < 0.7 * 50 * 4000
    best = vectors._Best(2, vectors._same, np.arange(1), np.array([[5.0, 1.0, 1.0]]))
    odd = np.array([[np.nan, 9.0], [9.0, 0.0], [3.0, 1.0]])
    best.add_block(np.arange(3), odd, np.array([[odd.min(0), odd.max(0)]]))
    assert best.rows().to_pylist()[0]["id"] == 1


def test_rows_of_like_norms_lie_by_direction():
    rng = np.random.default_rng(12)
    rows = np.zeros((900, 8))
    rows[np.arange(900), rng.integers(0, 8, 900)] = rng.choice([-1.0, 1.0], 900)
    rows *= np.repeat([4.0, 1.0, 0.5], 300)[:, None]
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(900)), pa.array(np.linalg.norm(rows, axis=1)), pa.array([r.tobytes() for r in rows])], names=["id", "norm", "payload"])
    blocks = [b for out in vectors._by_norm(50, 400, 1000)([batch]) for b in out.to_pylist()]
    assert [b["n"] for b in blocks] == [400, 400, 100] and [b["top"] for b in blocks] == [4.0, 1.0, 0.5]
    assert sorted(i for b in blocks for i in np.frombuffer(b["ids"], np.int64)) == list(range(900))
    first = np.frombuffer(blocks[0]["ids"], np.int64)[:300]
    assert set(first) == set(range(300))
    places = [(int(np.abs(rows[i]).argmax()), rows[i].sum() > 0) for i in first]
    assert sum(a != b for a, b in zip(places, places[1:])) == 15
    bounds = np.frombuffer(blocks[0]["boxes"], np.float64).reshape(2, 2, 8)
    assert (bounds[0, 0] == rows[first[:256]].min(0)).all() and (bounds[0, 1] == rows[first[:256]].max(0)).all()


def test_products_meet_where_the_shared_folder_is_no_file_system(spark, monkeypatch):
    rng = np.random.default_rng(13)
    base, users = rng.normal(size=(500, 5)), rng.normal(size=(40, 5))
    monkeypatch.setattr(vectors, "urlsplit", lambda file: type("Split", (), {"scheme": "other", "path": file}))
    found = vectors.largest_products(frame(spark, base), frame(spark, users), 3, block=20).found
    assert "CartesianProduct" in found._jdf.queryExecution().executedPlan().toString()
    score, got = np.round(users @ base.T, 6), {(r.query_id, r["rank"]): r.id for r in found.collect()}
    for u in range(40):
        assert [got[u, i + 1] for i in range(3)] == np.lexsort((np.arange(500), -score[u]))[:3].tolist()
