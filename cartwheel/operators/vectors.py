"""Exact search among vectors through an index: nearest by cosine, largest by inner product.

Queries and base vectors meet in blocks, one matrix product each. Which blocks a query visits is decided by bounds:
angles to pivots (triangle inequality) for cosines, norms for inner products. Results are exact whatever the bounds
leave; ``shares`` says how much that was.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions import scores
from cartwheel.operators import ranking
from cartwheel.session import scratch, ship_package

#: Most pivots of an index, vectors per block, queries per block, clusters that give a query its first threshold.
MOST_PIVOTS, BLOCK, QUERY_BLOCK, FIRST_VISITS = 1024, 2048, 256, 2
REFINEMENTS = 2
#: Of products: queries per block, bytes of a block and of a part of the base that a task holds, queries of a task.
QUERIES_MET, BLOCK_BYTES, PART_BYTES = 2048, 1 << 21, 1 << 27
QUERIES_HELD = 16_384
#: Rows of the base whose norms differ by less than this factor are ordered by direction, this many bytes at once; rows
#: that lie between the same bounds, element by element.
LIKE_NORMS, ORDERED_BYTES, BOXED = 1.25, 1 << 25, 256
#: Rows for each query of a block that are taken again one by one; more are taken by a product of the blocks.
FEW = 8
#: Similarities are rounded to six places before they are ranked, so bounds leave room for one rounding and float error.
SLACK = 2e-6
_BLOCK = "cluster int, n int, ids binary, payload binary"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array column of equal lengths as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _packed(size: int):
    """Rows (cluster, id, payload and perhaps threshold) come sorted by cluster; up to ``size`` of one become a block.

    A threshold goes in front of its row's payload, as eight bytes.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        at = None

        def flush():
            ids = np.array([i for i, _ in held], np.int64).tobytes()
            body = b"".join(p for _, p in held)
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([len(held)], pa.int32()), pa.array([ids]), pa.array([body])],
                names=["cluster", "n", "ids", "payload"],
            )

        for batch in batches:
            bodies = batch.column("payload").to_pylist()
            if "threshold" in batch.schema.names:
                bodies = [t.tobytes() + b for t, b in zip(batch.column("threshold").to_numpy(), bodies)]
            for cluster, key, payload in zip(batch.column("cluster").to_pylist(), batch.column("id").to_pylist(), bodies):
                if held and (cluster != at or len(held) == size):
                    yield flush()
                    held = []
                at = cluster
                held.append((key, payload))
        if held:
            yield flush()

    return pack


def _blocks(rows: DataFrame, size: int, counts: DataFrame | None = None) -> DataFrame:
    """Blocks of rows (cluster, id, payload); a cluster of many rows is dealt over several tasks by its count."""
    if counts is None:
        counts = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"))
    share = F.pmod(F.xxhash64("id"), F.ceil(F.col("_n") / (4 * size)))
    dealt = rows.join(counts, "cluster").select(*rows.columns, share.alias("_share"))
    return dealt.repartition("cluster", "_share").sortWithinPartitions("cluster", "_share").select(*rows.columns).mapInArrow(
        _packed(size), _BLOCK
    )


def _pairs(base: DataFrame, queries: DataFrame) -> DataFrame:
    asked = queries.select(
        "cluster", F.col("n").alias("m"), F.col("ids").alias("query_ids"), F.col("payload").alias("asked")
    )
    return base.join(asked, "cluster")


# -- nearest by cosine -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Index:
    """Written codes of all vectors, dealt to clusters around pivots.

    ``codes``: cluster, id, payload (scale, residual norm and one signed byte per element of the unit vector);
    ``blocks``: the same in blocks; ``clusters``: cluster, n, low, high (angles to the pivot). ``pivots`` has at most
    ``MOST_PIVOTS`` rows, whatever the number of vectors.
    """

    vectors: DataFrame
    blocks: DataFrame
    clusters: DataFrame
    pivots: np.ndarray


def _assign(pivots):
    """Nearest pivot, angle to it and code of each vector; a vector of zeros lies at any angle, so its is pi."""

    def run(batches):
        for batch in batches:
            unit = _unit(_matrix(batch.column("vector")))
            cosines = unit @ pivots.value.T
            cluster = cosines.argmax(axis=1) if len(unit) else np.zeros(0, np.int64)
            best = np.take_along_axis(cosines, cluster[:, None], 1)[:, 0] if len(unit) else np.zeros(0)
            angle = np.where((unit != 0).any(axis=1), np.arccos(np.clip(best, -1, 1)), np.pi)
            scale = np.abs(unit).max(axis=1, initial=0) / 127
            code = np.rint(np.divide(unit, scale[:, None], out=np.zeros_like(unit), where=scale[:, None] > 0)).astype(np.int8)
            lost = np.linalg.norm(unit - code * scale[:, None], axis=1)
            head = np.stack([scale, lost], axis=1)
            payload = [h.tobytes() + c.tobytes() for h, c in zip(head, code)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cluster.astype(np.int32)), batch.column("id"), pa.array(angle), pa.array(payload, pa.binary())],
                names=["cluster", "id", "angle", "payload"],
            )

    return run


def _sums(pivots):
    """Sums of the unit vectors of a batch by nearest pivot."""

    def run(batches):
        for batch in batches:
            unit = _unit(_matrix(batch.column("vector")))
            if len(unit):
                cluster = (unit @ pivots.value.T).argmax(axis=1)
                known = np.unique(cluster)
                sums = [unit[cluster == c].sum(axis=0) for c in known]
                yield pa.RecordBatch.from_arrays([pa.array(known.astype(np.int32)), pa.array(sums, pa.list_(pa.float64()))], names=["cluster", "sums"])

    return run


def build_index(base: DataFrame, most_pivots: int = MOST_PIVOTS, refinements: int = REFINEMENTS, block: int = BLOCK) -> Index:
    """Index of the vectors (id long, vector array of one length) of ``base``; rows without a vector are left out.

    The square root of the number of vectors, at most ``most_pivots``, are drawn as pivots by hash and moved to the
    mean direction of what is nearest to them, ``refinements`` times. Vectors go to their nearest pivot.
    """
    spark = base.sparkSession
    ship_package(spark)
    vectors = base.where("vector is not null").select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
    n = vectors.count()
    drawn = vectors.orderBy(F.xxhash64("id"), "id").limit(max(1, min(most_pivots, int(n**0.5)))).toArrow()
    pivots = _unit(_matrix(drawn.column("vector").combine_chunks()))
    coded = None
    for turn in range(refinements + 1):
        sent = spark.sparkContext.broadcast(pivots)
        coded = vectors.mapInArrow(_assign(sent), "cluster int, id long, angle double, payload binary")
        if turn == refinements or not n:
            break
        sums = vectors.mapInArrow(_sums(sent), "cluster int, sums array<double>").select("cluster", F.posexplode("sums").alias("i", "x"))
        moved = np.zeros_like(pivots)
        # A row for each pivot and element.
        for row in sums.groupBy("cluster", "i").agg(F.sum("x").alias("x")).collect():
            moved[row.cluster, row.i] = row.x
        moved = _unit(moved)
        pivots = np.where((moved != 0).any(axis=1, keepdims=True), moved, pivots)
    coded = _written(coded, "vector-codes")
    clusters = _written(
        coded.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high")),
        "vector-clusters",
    )
    counts = clusters.select("cluster", F.col("n").alias("_n"))
    blocks = _written(_blocks(coded.select("cluster", "id", "payload"), block, counts), "vector-blocks")
    return Index(vectors, blocks, clusters, pivots)


_VISITS = "query_id long, cluster int, bound double, place int"


def _visits(pivots, edges):
    """Clusters of each query in the order of the least angle that a vector of the cluster can have to it."""

    def run(batches):
        cluster, low, high = edges.value
        for batch in batches:
            unit = _unit(_matrix(batch.column("vector")))
            ids = batch.column("id").to_numpy()
            if not len(ids) or not len(cluster):
                continue
            angle = np.arccos(np.clip(unit @ pivots.value[cluster].T, -1, 1))
            bound = np.maximum(np.maximum(angle - high[None, :], low[None, :] - angle), 0)
            bound[:, high >= np.pi] = 0
            bound[~(unit != 0).any(axis=1)] = 0
            order = np.lexsort((angle, bound), axis=1)
            place = np.empty_like(order)
            np.put_along_axis(place, order, np.broadcast_to(np.arange(len(cluster)), order.shape), 1)
            many = np.repeat(np.arange(len(ids)), len(cluster))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[many]),
                    pa.array(np.tile(cluster, len(ids)).astype(np.int32)),
                    pa.array(bound.ravel()),
                    pa.array(place.ravel().astype(np.int32)),
                ],
                names=[c.split()[0] for c in _VISITS.split(", ")],
            )

    return run


def _directions(batches):
    for batch in batches:
        bodies = [row.tobytes() for row in _unit(_matrix(batch.column("vector")))]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(bodies, pa.binary())], names=["query_id", "payload"])


def _thresholds(rows: DataFrame, score: str, k: int) -> DataFrame:
    """The k-th best ``score`` of each query; minus infinity for a query with fewer rows."""
    best = ranking.top_n_per(rows, ["query_id"], [F.desc(score), F.col("id")], k)
    kth = F.when(F.count(F.lit(1)) >= k, F.min(score)).otherwise(F.lit(float("-inf")))
    return best.groupBy("query_id").agg(kth.alias("threshold"))


_CANDIDATES = "query_id long, id long, least double, most double"


def _candidates(k: int, exclude_self: bool):
    """Per pair of blocks: bounds of the cosine from the codes, for all that may be among the ``k`` best of a query.

    The payload of a query is its threshold so far and its unit vector.
    """

    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n", "ids", "payload", "m", "query_ids", "asked")]
            for n, ids, payload, m, query_ids, asked in zip(*columns):
                names, queries = np.frombuffer(ids, np.int64), np.frombuffer(query_ids, np.int64)
                raw = np.frombuffer(payload, np.uint8).reshape(n, -1)
                head = raw[:, :16].copy().view(np.float64)
                base = raw[:, 16:].view(np.int8).astype(np.float64) * head[:, :1]
                wanted = np.frombuffer(asked, np.float64).reshape(m, -1)
                near, lost = base @ wanted[:, 1:].T, head[:, 1:]
                least, most = near - lost, near + lost
                if exclude_self:
                    own = names[:, None] == queries[None, :]
                    least, most = np.where(own, -np.inf, least), np.where(own, -np.inf, most)
                threshold = wanted[:, 0]
                if n > k:
                    threshold = np.maximum(threshold, np.partition(least, n - k, axis=0)[n - k])
                row, column = np.nonzero((most >= threshold[None, :] - SLACK) & np.isfinite(most))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries[column]), pa.array(names[row]), pa.array(least[row, column]), pa.array(most[row, column])],
                    names=[c.split()[0] for c in _CANDIDATES.split(", ")],
                )

    return run


@dataclass(frozen=True)
class Search:
    """``found`` (query_id, id, similarity, rank) of a search and, for ``shares``, what it compared."""

    index: Index
    n_queries: DataFrame
    visits: DataFrame
    candidates: DataFrame
    found: DataFrame

    def shares(self) -> DataFrame:
        """One row: pairs of query and vector whose codes were compared and whose vectors were, of all pairs."""
        visited = self.visits.groupBy("cluster").agg(F.count(F.lit(1)).alias("times")).join(self.index.clusters, "cluster")
        some = [
            ("n_vectors", self.index.clusters.agg(F.coalesce(F.sum("n"), F.lit(0)))),
            ("codes_compared", visited.agg(F.coalesce(F.sum(F.col("times") * F.col("n")), F.lit(0)))),
            ("vectors_compared", self.candidates.agg(F.count(F.lit(1)))),
        ]
        counted = self.n_queries.select("n_queries", *[df.scalar().alias(name) for name, df in some])
        pairs = F.col("n_queries") * F.col("n_vectors")
        return counted.withColumns(
            {"codes_share": F.try_divide("codes_compared", pairs), "vectors_share": F.try_divide("vectors_compared", pairs)}
        )


def _cosine(a: str, b: str) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.round(dot / (scores.norm(F.col(a)) * scores.norm(F.col(b)) + scores.COSINE_EPS), 6)


def search(index: Index, queries: DataFrame, k: int, exclude_self: bool = False, first: int = FIRST_VISITS) -> Search:
    """The ``k`` vectors of the index most similar (cosine, ties by id) to each query (id, vector), exactly.

    1. A query's angles to the pivots bound its angle to every vector of a cluster from below; they order its visits.
    2. The first visits, as many as hold ``k`` + 1 vectors and at least ``first``, are made on the codes. The k-th best
       cosine that is certain is the query's threshold.
    3. Clusters that may hold a better one are visited, again on the codes, which are an eighth of the vectors in size;
       each visit leaves the vectors whose cosine may reach the threshold.
    4. Those are compared with their whole vectors, and the best ``k`` of each query stay.
    """
    spark = index.vectors.sparkSession
    asked = queries.where("vector is not null").select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
    # At most MOST_PIVOTS rows.
    edges = index.clusters.select("cluster", "n", "low", "high").orderBy("cluster").toArrow()
    numbers = [edges.column(c).to_numpy() for c in ("cluster", "low", "high")]
    pivots, sent = spark.sparkContext.broadcast(index.pivots), spark.sparkContext.broadcast(numbers)
    visits = asked.mapInArrow(_visits(pivots, sent), _VISITS)
    smallest = int(edges.column("n").to_numpy().min()) if len(edges) else 1
    early = F.col("place") < max(first, -(-(k + 1) // smallest))

    units = asked.mapInArrow(_directions, "query_id long, payload binary")

    def compare(chosen: DataFrame) -> DataFrame:
        rows = chosen.join(units, "query_id").select("cluster", F.col("query_id").alias("id"), "payload", "threshold")
        return _pairs(index.blocks, _blocks(rows, QUERY_BLOCK)).mapInArrow(_candidates(k, exclude_self), _CANDIDATES)

    none = F.lit(float("-inf"))
    begun = _written(compare(visits.where(early).withColumn("threshold", none)), "vector-first")
    thresholds = _thresholds(begun, "least", k)
    rest = visits.where(~early).join(thresholds, "query_id", "left").withColumn("threshold", F.coalesce("threshold", none))
    rest = rest.where(F.cos("bound") >= F.col("threshold") - SLACK)
    later = compare(rest)
    both = begun.unionByName(later).join(thresholds, "query_id", "left").where(F.col("most") >= F.coalesce("threshold", none) - SLACK)
    candidates = both.select("query_id", "id").distinct()
    named = candidates.join(index.vectors.withColumnRenamed("vector", "a"), "id").join(
        asked.select(F.col("id").alias("query_id"), F.col("vector").alias("b")), "query_id"
    )
    scored = named.select("query_id", "id", _cosine("a", "b").alias("similarity"))
    found = ranking.top_n_per(scored, ["query_id"], [F.desc("similarity"), F.col("id")], k)
    made = visits.where(early).select("query_id", "cluster").unionByName(rest.select("query_id", "cluster"))
    return Search(index, asked.agg(F.count(F.lit(1)).alias("n_queries")), made, candidates, found)


# -- largest by inner product ------------------------------------------------------------------------------------


def _bodies(batches):
    """Vectors as bytes with their norms."""
    for batch in batches:
        rows = _matrix(batch.column("vector"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(np.linalg.norm(rows, axis=1)), pa.array([r.tobytes() for r in rows], pa.binary())],
            names=["id", "norm", "payload"],
        )


_BASE = "n int, top double, groups array<struct<top: double, n: bigint>>, ids binary, payload binary, boxes binary"
_BEST = "query_id long, id long, score double, key double"
_ASKED = "id long, payload binary, threshold double, least_top double, compared long"
_ASKED_BLOCK = "number long, m int, own int, least_top double, compared long, query_ids binary, asked binary"


def _by_direction(rows: np.ndarray) -> np.ndarray:
    """An order in which rows whose two greatest elements, by size and sign, are in the same places lie together."""
    if not rows.shape[1]:
        return np.arange(len(rows))
    size, every = np.nan_to_num(np.abs(rows)), np.arange(len(rows))
    first = size.argmax(1)
    size[every, first] = -1.0
    second = size.argmax(1)
    return np.lexsort((rows[every, second] < 0, second, rows[every, first] < 0, first))


def _by_norm(per_group: int, size: int, most: int):
    """Rows (id, norm, payload) come with falling norms; up to ``size`` become a block, in groups of ``per_group``.

    Rows of like norms, ``most`` at once, are ordered by direction. For every ``BOXED`` rows of a block ``boxes`` has the
    least and the greatest value of each element.
    """

    def pack(batches):
        held: list[tuple[int, float, bytes]] = []
        ordered: list[tuple[int, float, bytes]] = []

        def flush(rows):
            body = b"".join(r[2] for r in rows)
            matrix, norms = np.frombuffer(body, np.float64).reshape(len(rows), -1), np.array([r[1] for r in rows])
            groups = [{"top": norms[i : i + per_group].max(), "n": min(per_group, len(rows) - i)} for i in range(0, len(rows), per_group)]
            boxes = [f(matrix[i : i + BOXED], axis=0) for i in range(0, len(rows), BOXED) for f in (np.min, np.max)]
            columns = [
                pa.array([len(rows)], pa.int32()), pa.array([norms.max()]), pa.array([groups], pa.list_(pa.struct([("top", pa.float64()), ("n", pa.int64())]))),
                pa.array([np.array([r[0] for r in rows], np.int64).tobytes()]), pa.array([body]), pa.array([np.concatenate(boxes).tobytes()]),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["n", "top", "groups", "ids", "payload", "boxes"])

        def like():
            matrix = np.frombuffer(b"".join(h[2] for h in held), np.float64).reshape(len(held), -1)
            ordered.extend(held[i] for i in _by_direction(matrix))
            held.clear()

        def blocks(last: bool):
            whole = len(ordered) if last else len(ordered) // size * size
            for at in range(0, whole, size):
                yield flush(ordered[at : min(at + size, whole)])
            del ordered[:whole]

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "norm", "payload"))):
                if held and (len(held) >= most or not row[1] * LIKE_NORMS >= held[0][1]):
                    like()
                    yield from blocks(False)
                held.append(row)
        if held:
            like()
        yield from blocks(True)

    return pack


def _reached(first, groups, k: int, key):
    """Threshold of each query, its k-th best key among the longest rows, and the least norm of a group that reaches it.

    The greatest norms of the groups fall, so what a query can reach is a beginning of their list; halving finds its end.
    """

    def run(batches):
        longest, (tops, sizes) = first.value, groups.value
        before = np.r_[0, np.cumsum(sizes)]
        for batch in batches:
            norm, bodies = batch.column("norm").to_numpy(), batch.column("payload").to_pylist()
            threshold = np.full(len(norm), -np.inf)
            for at in range(0, len(norm) if len(longest) >= k else 0, QUERY_BLOCK):
                some = bodies[at : at + QUERY_BLOCK]
                best = key(np.round(np.frombuffer(b"".join(some), np.float64).reshape(len(some), -1) @ longest.T, 6))
                threshold[at : at + QUERY_BLOCK] = np.partition(best, len(longest) - k, axis=1)[:, len(longest) - k]
            low, high = np.zeros(len(norm), np.int64), np.full(len(norm), len(tops))
            while (low < high).any():
                middle = (low + high) // 2
                reach = key(norm * tops[np.minimum(middle, len(tops) - 1)] * (1 + 1e-9) + 1e-6)
                yes = (low < high) & (reach >= threshold - SLACK)
                low, high = np.where(yes, middle + 1, low), np.where(yes, high, np.minimum(middle, high))
            least = np.where(low > 0, np.r_[np.inf, tops][low], np.inf)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("payload"), pa.array(threshold), pa.array(least), pa.array(before[low].astype(np.int64))],
                names=["id", "payload", "threshold", "least_top", "compared"],
            )

    return run


def _asked_blocks(size: int):
    """Up to ``size`` queries that reach about as far become a block; thresholds stand in front of the vectors."""

    def pack(batches):
        held, number = [], 0

        def flush():
            ids = np.array([h[0] for h in held], np.int64).tobytes()
            body = b"".join(np.float64(h[2]).tobytes() + h[1] for h in held)
            columns = [
                pa.array([number], pa.int64()), pa.array([len(held)], pa.int32()), pa.array([sum(h[5] for h in held)], pa.int32()), pa.array([min(h[3] for h in held)], pa.float64()),
                pa.array([sum(h[4] for h in held)], pa.int64()), pa.array([ids]), pa.array([body]),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["number", "m", "own", "least_top", "compared", "query_ids", "asked"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "payload", "threshold", "least_top", "compared", "own"))):
                held.append(row)
                if len(held) == size:
                    yield flush()
                    held, number = [], number + 1
        if held:
            yield flush()

    return pack


class _Best:
    """The ``k`` best rows so far, by key, then id, of each query of a block (ids, and thresholds with vectors).

    Products are taken with 32 bits first. Those that their error may let in, few in most blocks, are taken again with
    64 bits, and these decide.
    """

    def __init__(self, k: int, key, queries: np.ndarray, asked: np.ndarray):
        self.k, self.key, self.queries, self.asked = k, key, queries, asked[:, 1:]
        self.length = np.linalg.norm(self.asked, axis=1)
        with np.errstate(over="ignore"):
            self.short = self.asked.astype(np.float32)
        self.above, self.below = np.maximum(self.asked, 0.0), np.minimum(self.asked, 0.0)
        self.row, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.score, self.rank = np.zeros(0), np.zeros(0)
        # A row must have a key above ``least``, or the same and an id before ``last``.
        self.least, self.last = asked[:, 0] - SLACK, np.full(len(queries), np.iinfo(np.int64).max)
        # Products below ``floor`` have a lesser key, those up to ``ceiling`` none that is greater; for norms up to ``top``.
        self.floor, self.ceiling, self.top = np.full(len(queries), -np.inf), np.full(len(queries), -np.inf), -np.inf

    def _bounds(self, some: np.ndarray) -> None:
        """Floor and ceiling of the queries in ``some``, by halving, as the key never falls."""
        if self.key is _same:
            self.floor[some] = self.least[some] - SLACK
            return
        reach = self.length[some] * self.top * (1 + 1e-9) + 1e-6
        for bound, below in ((self.floor, lambda x: x < self.least[some] - SLACK), (self.ceiling, lambda x: x <= self.least[some])):
            low, high = -reach, reach.copy()
            for _ in range(40):
                middle = (low + high) / 2
                under = below(self.key(np.round(middle, 6)))
                low, high = np.where(under, middle, low), np.where(under, high, middle)
            low = np.where(below(self.key(np.round(high, 6))), np.inf, low)
            bound[some] = np.where(below(self.key(np.round(-reach, 6))), low - SLACK, -np.inf)

    def _reach(self, norm: float) -> None:
        """Let the bounds hold for rows of this norm."""
        if norm > self.top:
            self.top = norm
            self._bounds(np.arange(len(self.asked)))

    def _possible(self, names: np.ndarray, base: np.ndarray, some) -> np.ndarray:
        """What may be among the best of ``some`` queries, judged by products of 32 bits."""
        norm, length = np.linalg.norm(base, axis=1).max(initial=0), self.length[some]
        if not (norm < 1e18 and length.max(initial=0) < 1e18):
            return np.ones((len(length), len(base)), bool)
        self._reach(norm)
        # Rounding of the elements and of their sum, with room for that of the bounds.
        error = (base.shape[1] + 8) * 2.0**-23 * length * norm
        near = self.short[some] @ base.astype(np.float32).T
        may = near >= np.nextafter((self.floor[some] - error).astype(np.float32), np.float32(-np.inf))[:, None]
        if self.key is not _same:
            # Many products can share a key; behind the last id only a greater one counts.
            tied = near < np.nextafter((self.ceiling[some] - error).astype(np.float32), np.float32(-np.inf))[:, None]
            may &= ~(tied & (names[None, :] >= self.last[some][:, None]))
        return may

    def add_block(self, names: np.ndarray, base: np.ndarray, boxes: np.ndarray) -> None:
        """Add rows with the least and greatest elements of every ``BOXED`` of them, which tell what queries can't reach."""
        low, high = boxes[:, 0], boxes[:, 1]
        with np.errstate(over="ignore", invalid="ignore"):
            most = self.above @ high.T + self.below @ low.T
            # No row is longer than its box's corner; what it leaves to rounding is far less than this.
            corner = np.linalg.norm(np.maximum(np.abs(low), np.abs(high)), axis=1)
            most += 1e-12 * self.length[:, None] * corner[None, :]
        if np.isfinite(corner).all():
            self._reach(corner.max(initial=0))
        for i in range(len(boxes)):
            part = slice(i * BOXED, (i + 1) * BOXED)
            # A bound that is no number leaves nothing out.
            rows = np.flatnonzero(~(most[:, i] < self.floor))
            if 4 * len(rows) > 3 * len(most):
                self.add(names[part], base[part])
            elif len(rows):
                self.add(names[part], base[part], rows)

    def add(self, names: np.ndarray, base: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Add rows for all queries, or for those at the places ``rows``; the others can't reach them."""
        some = slice(None) if rows is None else rows
        may = self._possible(names, base, some)
        many, score = np.count_nonzero(may), None
        if many > FEW * len(may):
            score = self.asked[some] @ base.T
        if len(names) > self.k and many > 4 * self.k * len(may):
            rank = score if self.key is _same else self.key(np.round(score, 6))
            may &= rank >= self.least[some][:, None] - SLACK
            if np.count_nonzero(may) > 4 * self.k * len(may):
                kth = np.partition(rank, len(names) - self.k, axis=1)[:, len(names) - self.k]
                may &= rank >= kth[:, None] - SLACK
        # Much faster than ``nonzero`` of a matrix with few places.
        row, column = np.divmod(np.flatnonzero(may), len(names))
        taken = None if score is None else score[row, column]
        row = row if rows is None else rows[row]
        exact = np.einsum("ij,ij->i", self.asked[row], base[column]) if taken is None else taken
        found, ids = np.round(exact, 6), names[column]
        rank = self.key(found)
        better = (rank > self.least[row]) | ((rank == self.least[row]) & (ids < self.last[row]))
        if not better.any():
            return
        touched = np.zeros(len(self.queries), bool)
        touched[row[better]] = True
        old = touched[self.row]
        row, ids = np.r_[self.row[old], row[better]], np.r_[self.id[old], ids[better]]
        found, rank = np.r_[self.score[old], found[better]], np.r_[self.rank[old], rank[better]]
        order = np.lexsort((ids, -rank, row))
        row, ids, found, rank = row[order], ids[order], found[order], rank[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        last, keep = place == self.k - 1, place < self.k
        self.least[row[last]], self.last[row[last]] = rank[last], ids[last]
        self.row, self.id = np.r_[self.row[~old], row[keep]], np.r_[self.id[~old], ids[keep]]
        self.score, self.rank = np.r_[self.score[~old], found[keep]], np.r_[self.rank[~old], rank[keep]]
        if last.any():
            self._bounds(row[last])

    def rows(self) -> pa.RecordBatch:
        columns = [self.queries[self.row], self.id, self.score, self.rank]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "id", "score", "key"])


def _best_products(k: int, key):
    """Pairs of blocks, those of one block of queries one behind the other: the ``k`` best of each query."""

    def run(batches):
        at, best = None, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "number", "n", "ids", "payload", "boxes", "m", "query_ids", "asked")]
            for part, number, n, ids, payload, boxes, m, query_ids, asked in zip(*columns):
                if at != (part, number):
                    if best is not None:
                        yield best.rows()
                    at = (part, number)
                    best = _Best(k, key, np.frombuffer(query_ids, np.int64), np.frombuffer(asked, np.float64).reshape(m, -1))
                bounds = np.frombuffer(boxes, np.float64).reshape(-(-n // BOXED), 2, -1)
                best.add_block(np.frombuffer(ids, np.int64), np.frombuffer(payload, np.float64).reshape(n, -1), bounds)
        if best is not None:
            yield best.rows()

    return run


def _best_of_files(paths: list[str], k: int, key):
    """Blocks of queries against all blocks of the base in ``paths``: the ``k`` best of each query."""

    def against(held):
        for path in paths:
            with pq.ParquetFile(path, pre_buffer=False, buffer_size=BLOCK_BYTES) as file:
                for some in file.iter_batches(batch_size=1, columns=["n", "top", "ids", "payload", "boxes"]):
                    for n, top, ids, payload, boxes in zip(*(c.to_pylist() for c in some.columns)):
                        names, base = np.frombuffer(ids, np.int64), np.frombuffer(payload, np.float64).reshape(n, -1)
                        bounds = np.frombuffer(boxes, np.float64).reshape(-(-n // BOXED), 2, -1)
                        for least_top, best in held:
                            if top >= least_top:
                                best.add_block(names, base, bounds)
        for _, best in held:
            yield best.rows()

    def run(batches):
        held = []
        for batch in batches:
            for least_top, m, query_ids, asked in zip(*(batch.column(c).to_pylist() for c in ("least_top", "m", "query_ids", "asked"))):
                queries = np.frombuffer(query_ids, np.int64)
                held.append((least_top, _Best(k, key, queries, np.frombuffer(asked, np.float64).reshape(m, -1))))
                if sum(len(best.queries) for _, best in held) >= QUERIES_HELD:
                    yield from against(held)
                    held = []
        if held:
            yield from against(held)

    return run


def _same(scores_):
    return scores_


@dataclass(frozen=True)
class Products:
    """``found``: query_id, id, score, key, rank; ``shares``: one row of pairs compared, all pairs and their quotient."""

    found: DataFrame
    shares: DataFrame


def largest_products(
    base: DataFrame, queries: DataFrame, k: int, key=_same, groups: int = MOST_PIVOTS, block: int = BLOCK
) -> Products:
    """The ``k`` rows of ``base`` with the largest inner product with each query; both are (id long, vector array).

    Products are rounded to six places and ranked by ``key`` of them (a function of numpy arrays that never falls as
    the product grows), then by id.

    Rows of ``base`` lie in groups of ``block`` by norm, the greatest first, in larger groups if there were more than
    ``groups``. The k-th best key among the rows of the first group is a query's threshold, and it meets only groups
    whose greatest norm times its own norm can reach that. Queries that reach about as far share a block. Rows of like
    norms are ordered by direction, and a query is compared with ``BOXED`` rows only if their greatest and least elements
    leave it a product that reaches its k-th so far. Each side is shuffled and written once, in blocks of at most
    ``BLOCK_BYTES``. A task then holds ``QUERIES_HELD`` queries and reads the blocks of the base from their files, one
    behind the other, which shuffles and broadcasts nothing, and leaves ``k`` rows for each of its queries. From a shared
    folder that is no file system of the executors, blocks meet as a product of partitions instead, a task holding
    ``PART_BYTES`` of the base.
    """
    spark = base.sparkSession
    ship_package(spark)
    rows, asked = (
        df.where("vector is not null")
        .select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
        .mapInArrow(_bodies, "id long, norm double, payload binary")
        for df in (base, queries)
    )
    rows = _written(rows, "product-rows")
    n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.length("payload")), F.lit(0))).first()
    size = max(1, min(BLOCK, BLOCK_BYTES // (width + 8)))
    per_group, parts = min(size, max(block, -(-n // groups))), -(-n * (width + 8) // PART_BYTES) or 1
    falling = [F.desc("norm"), F.asc("id")]
    blocks = rows.repartitionByRange(parts, *falling).sortWithinPartitions(*falling).mapInArrow(
        _by_norm(per_group, size, max(size, ORDERED_BYTES // (width + 8))), _BASE
    )
    blocks = _written(blocks, "product-blocks")
    # One row for each group, and the rows of one.
    listed = blocks.select(F.inline("groups")).orderBy(F.desc("top")).toArrow()
    longest = rows.orderBy(*falling).limit(max(k, per_group)).select("payload").toArrow().column("payload").to_pylist()
    first = np.frombuffer(b"".join(longest), np.float64).reshape(len(longest), -1) if longest else np.zeros((0, 0))
    sent = [spark.sparkContext.broadcast(x) for x in (first, [listed.column(c).to_numpy() for c in ("top", "n")])]
    # Every partition has queries of all reaches, as those that reach far take longer.
    spread = asked.mapInArrow(_reached(*sent, k, key), _ASKED).repartition(2 * spark.sparkContext.defaultParallelism, "id")
    # Rows of one query id are one query that holds each of them as often as there are rows; more than k change nothing.
    times = F.least(F.count(F.lit(1)).over(Window.partitionBy("id")), F.lit(k)).cast("int")
    copied = spread.withColumn("_times", times).select("*", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)).alias("_copy"))
    own = F.col("_copy") == 0
    spread = copied.withColumns({"own": own, "compared": F.when(own, F.col("compared")).otherwise(F.lit(0))})
    packed = spread.sortWithinPartitions("least_top", "id").mapInArrow(_asked_blocks(min(QUERIES_MET, size)), _ASKED_BLOCK)
    wanted = _written(packed.withColumn("part", F.spark_partition_id()), "product-queries")
    files = [urlsplit(file) for file in sorted(blocks.inputFiles())]
    asking = wanted.select("part", "number", "least_top", "m", "query_ids", "asked")
    if all(file.scheme in ("", "file") for file in files):
        best = asking.mapInArrow(_best_of_files([unquote(file.path) for file in files], k, key), _BEST)
    else:
        held = blocks.select("n", "top", "ids", "payload", "boxes").coalesce(parts).hint("shuffle_replicate_nl")
        best = asking.join(held, F.col("top") >= F.col("least_top")).mapInArrow(_best_products(k, key), _BEST)
    found = ranking.top_n_per(best, ["query_id"], [F.desc("key"), F.col("id")], k)
    compared = wanted.agg(F.coalesce(F.sum("compared"), F.lit(0)).alias("compared"), (F.coalesce(F.sum("own"), F.lit(0)) * n).alias("pairs"))
    return Products(found, compared.withColumn("share", F.try_divide("compared", "pairs")))
