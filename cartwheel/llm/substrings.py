"""Repeated passages, found by refining buckets of q-grams with the buckets at later offsets."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import bitmap, in_bitmap, numbered, python_ready, slices, whole_text, written

LENGTH, Q = 100, 25
#: q-grams that lie within one window.
GRAMS = LENGTH - Q + 1
#: A window holds all of its anchor's next SIDE bytes to the left, or all of those to the right.
SIDE = (LENGTH - Q + 1) // 2
#: Sides of one bucket that one task compares.
GROUP = 512
PLACE = ("doc_id", "row", "place", "low", "high")
PLACE_BITS = 31
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def refine(bucket, later):
    """Bucket identifier of a longer string from the identifiers at its start and at a later offset."""
    x = (bucket ^ (later * M2 + (later >> np.uint64(29)))) * M1
    x ^= x >> np.uint64(32)
    x *= M3
    return x ^ (x >> np.uint64(29))


def digest(raw, salt: bytes = b"") -> bytes:
    return hashlib.blake2b(raw, digest_size=16, salt=salt).digest()


def gram_buckets(raw: np.ndarray) -> np.ndarray:
    """Identifier of the 25-byte string at each place that has one."""
    n = len(raw) - Q + 1
    padded = np.concatenate([raw, np.zeros(16, np.uint8)])
    eight = np.empty(len(raw), np.uint64)
    for k in range(8):
        part = padded[k : k + (len(raw) - k + 7) // 8 * 8]
        eight[k::8] = part[: len(part) // 8 * 8].view(np.uint64)[: len(eight[k::8])]
    first = refine(eight[: n + 8], eight[8 : n + 16]) if n + 16 <= len(eight) else refine(eight[: n + 8], np.r_[eight[8:], np.zeros(8, np.uint64)][: n + 8])
    # 16 bytes, 16 bytes eight later, and the last byte with its seven before.
    return refine(refine(first[:n], first[8 : n + 8]), eight[17 : n + 17])


def anchors(buckets: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Anchors of documents that lie at starts..ends of one buffer: place, first and last window, document.

    The anchor of a window is the leftmost of its q-grams with the least mixed bucket; it depends on the window's bytes
    alone, so equal windows have the same anchor at the same offset.
    """
    n = len(buckets) - GRAMS + 1
    key = refine(buckets, buckets) >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS) | np.arange(len(buckets), dtype=np.uint64)
    blocks = np.concatenate([key, np.full(-len(key) % GRAMS, ~np.uint64(0))]).reshape(-1, GRAMS)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(backward[:n], forward[GRAMS - 1 : GRAMS - 1 + n])
    place = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    long = np.flatnonzero(ends - starts >= LENGTH)
    change = np.r_[True, place[1:] != place[:-1]]
    inside = np.zeros(n + 1, np.int32)
    inside[starts[long]] += 1
    inside[ends[long] - LENGTH + 1] -= 1
    valid = np.cumsum(inside[:n]) > 0
    change[starts[long]] = True
    first = np.flatnonzero(valid & change)
    stop = np.flatnonzero(valid & ~np.r_[valid[1:] & ~change[1:], False])
    return place[first], first, stop, long[np.searchsorted(starts[long], first, side="right") - 1]


class Slice:
    """The documents of one Arrow slice in one buffer, with their anchors."""

    def __init__(self, part):
        column = part.column("text").cast(pa.large_binary())
        sizes = np.fromiter((len(x) for x in (v.as_buffer() for v in column)), np.int64, len(column))
        self.raw = np.frombuffer(b"".join(v.as_buffer() for v in column), np.uint8)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.row = part.column("row").to_numpy()
        self.doc_id = part.column("doc_id")
        if len(self.raw) < LENGTH or not (sizes >= LENGTH).any():
            self.place = self.low = self.high = self.doc = np.zeros(0, np.int64)
            self.buckets = np.zeros(0, np.uint64)
        else:
            self.buckets = gram_buckets(self.raw)
            self.place, self.low, self.high, self.doc = anchors(self.buckets, self.starts, self.ends)

    def keep(self, chosen):
        for name in ("place", "low", "high", "doc"):
            setattr(self, name, getattr(self, name)[chosen])

    def names(self) -> np.ndarray:
        """128 bits of each anchor: a digest of the bytes of all its windows, salted with where they lie around it.

        Buckets are mixes that can be inverted, so texts can be made that share one; they only pick what is looked at.
        What counts as equal is decided by this digest or by the bytes.
        """
        view, salt = memoryview(self.raw), (self.place - self.low) << 8 | (self.high - self.low)
        spans = zip(self.low.tolist(), self.high.tolist(), salt.astype("<i8").tolist())
        made = (digest(view[low : high + LENGTH], at.to_bytes(8, "little")) for low, high, at in spans)
        return np.frombuffer(b"".join(made), np.uint64).reshape(-1, 2)

    def ids(self, at):
        return self.doc_id.take(pa.array(at, pa.int64()))


def _order(part: Slice, doc, at):
    """Places of the order (doc_id, row, place) among the slice's rows; no doc_id comes first."""
    ids = part.doc_id.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
    return np.lexsort((at, part.row[doc], ids[doc], part.doc_id.is_valid().to_numpy(zero_copy_only=False)[doc]))


def _repeats(part: Slice, one, two, doc, at):
    """Within the slice: which entries are the first with their two identifiers."""
    order = _order(part, doc, at)
    _, first = np.unique(np.stack([one[order], two[order]], 1), axis=0, return_index=True) if len(one) else (None, np.zeros(0, int))
    out = np.zeros(len(one), bool)
    out[order[first]] = True
    return out


def _count_buckets(batches):
    for batch in slices(batches):
        part = Slice(batch)
        bucket, n = np.unique(part.buckets[part.place], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])


SPANS = "doc_id long, row long, place int, low int, high int, s1 long, s2 long, lk long, rk long"
LOCAL = -1


def _find_spans(repeated):
    """Anchors whose bucket occurs again, with a digest of the bytes of all their windows together.

    lk and rk are the buckets refined by those further left and right, as far as a window reaches on one side at
    least. Where the slice itself has the span before, all its windows are repeats: such spans are merged to intervals
    of bytes (place LOCAL, low and high are the ends).
    """

    def run(batches):
        for batch in slices(batches):
            part = Slice(batch)
            part.keep(in_bitmap(repeated.value, part.buckets[part.place]) if len(part.place) else slice(0))
            s1, s2 = part.names().T
            first = _repeats(part, s1, s2, part.doc, part.place)
            base = part.starts[part.doc]
            low, stop, doc = (part.low - base)[~first], (part.high - base)[~first] + LENGTH, part.doc[~first]
            new = np.r_[True, (doc[1:] != doc[:-1]) | (low[1:] > stop[:-1])][: len(doc)]
            at = np.flatnonzero(new)
            low, stop, doc = low[at], stop[np.r_[at[1:] - 1, len(stop) - 1]] if len(at) else stop, doc[at]
            part.keep(first)
            place, b = part.place, part.buckets
            left, right = part.low <= place - SIDE, part.high >= place - SIDE + 1
            lk, rk = np.zeros(len(place), np.uint64), np.zeros(len(place), np.uint64)
            p = place[left]
            lk[left] = refine(refine(b[p - SIDE], b[p - SIDE + Q]), b[p])
            p = place[right]
            rk[right] = refine(refine(b[p], b[p + Q]), b[p + SIDE])
            base, none = part.starts[part.doc], np.ones(len(doc), bool)
            docs = np.r_[part.doc, doc]

            def ints(own, interval):
                return pa.array(np.r_[own, interval].astype(np.int32))

            def longs(own, interval, missing=None):
                return pa.array(np.r_[own, interval.astype(np.uint64)].view(np.int64), mask=missing)

            yield pa.RecordBatch.from_arrays(
                [part.ids(docs), pa.array(part.row[docs]), ints(place - base, np.full(len(doc), LOCAL))]
                + [ints(part.low - base, low), ints(part.high - base, stop)]
                + [longs(s1[first], part.row[doc]), longs(s2[first], low)]
                + [longs(lk, low, np.r_[~left, none]), longs(rk, low, np.r_[~right, none])],
                names=[c.split()[0] for c in SPANS.split(", ")],
            )

    return run


SIDES = "side int, k long, salts int, salt int, doc_id long, row long, place int, start int, body binary"


def _show_sides(batches):
    """The bytes of the windows on each side in question: left side, those that hold SIDE bytes left of the anchor."""
    for batch in slices(batches):
        rows = []
        texts, ids, numbers = batch.column("text"), batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
        for text, doc_id, row, sides in zip(texts, ids, numbers, batch.column("sides").to_pylist()):
            raw = text.as_buffer().to_pybytes()
            for s in sides:
                place = s["place"]
                start = s["low"] if s["side"] == 0 else max(s["low"], place - SIDE + 1)
                last = min(s["high"], place - SIDE) if s["side"] == 0 else s["high"]
                rows.append((s["side"], s["k"], s["salts"], s["salt"], doc_id, row, place, start, raw[start : last + LENGTH]))
        columns = list(zip(*rows)) if rows else [[]] * 9
        kinds = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in SIDES.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in SIDES.split(", ")])


FOUND = "doc_id long, row long, start int, stop int, side int, k long, off int, w1 long, w2 long"


def _resolve(batches):
    """Rows come sorted by (side, k, salt) and place in the order of texts: all but the first of equal windows at the
    same offset are repeats, as intervals. Where the bucket has several salts, first ones go on with identifiers."""
    group, seen = None, set()
    for batch in batches:
        found = []
        for side, k, salts, salt, doc_id, row, place, start, body in zip(*(c.to_pylist() for c in batch.columns)):
            if (side, k, salt) != group:
                group, seen = (side, k, salt), set()
            open_ = None
            for i in range(len(body) - LENGTH + 1):
                window = (place - start - i, body[i : i + LENGTH])
                if window in seen:
                    if open_ is None:
                        open_ = start + i
                    continue
                if open_ is not None:
                    found.append((doc_id, row, open_, start + i - 1 + LENGTH, None, None, None, None, None))
                    open_ = None
                seen.add(window)
                if salts > 1:
                    mark = np.frombuffer(digest(window[1]), np.int64).tolist()
                    found.append((doc_id, row, start + i, start + i + LENGTH, side, k, window[0], *mark))
            if open_ is not None:
                found.append((doc_id, row, open_, start + len(body), None, None, None, None, None))
        columns = list(zip(*found)) if found else [[]] * 9
        kinds = [{"int": pa.int32(), "long": pa.int64()}[c.split()[1]] for c in FOUND.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in FOUND.split(", ")])


def _cut(batches):
    """Merge a document's intervals and hash what lies outside of them."""
    for batch in slices(batches):
        n_bytes, removed, runs, digests = [], [], [], []
        for text, cuts in zip(batch.column("text"), batch.column("cuts").to_pylist()):
            raw = text.as_buffer().to_pybytes()
            digest, at, gone, n = hashlib.sha256(), 0, 0, 0
            end = -1
            for cut in sorted((c["start"], c["stop"]) for c in cuts or ()):
                if cut[0] > end:
                    n += 1
                    digest.update(raw[at : cut[0]])
                    end = cut[0]
                gone += max(0, cut[1] - end)
                end = at = max(end, cut[1])
            digest.update(raw[at:])
            n_bytes.append(len(raw))
            removed.append(gone)
            runs.append(n)
            digests.append(digest.hexdigest())
        longs = [pa.array(x, pa.int64()) for x in (n_bytes, removed, runs)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *longs, pa.array(digests, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def repeated_intervals(source: DataFrame, most: int = GROUP) -> DataFrame:
    """row, start and stop (bytes) of intervals that together cover each later repeat; see ``drop_repeats``."""
    spark = source.sparkSession
    counts = source.mapInArrow(_count_buckets, "key long, n long")
    again = written(counts.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"), "substr-buckets")
    repeated = spark.sparkContext.broadcast(bitmap(again))
    # One row per slice at most for the same bytes, so this window holds no open-ended group.
    same = Window.partitionBy("s1", "s2").orderBy("doc_id", "row", "place")
    marked = written(
        source.mapInArrow(_find_spans(repeated), SPANS)
        .withColumn("first", (F.row_number().over(same) == 1) & (F.col("place") != LOCAL))
        .drop("s1", "s2"),
        "substr-spans",
    )
    sides = marked.where("first").select(
        F.inline(F.array(*[F.struct(F.lit(side).alias("side"), F.col(k).alias("k"), *PLACE) for side, k in ((0, "lk"), (1, "rk"))]))
    ).where("k is not null")
    shared = written(sides.groupBy("side", "k").agg(F.count("*").alias("n")).where("n > 1"), "substr-shared")
    salts = F.ceil(F.col("n") / most).cast("int")
    open_ = (
        sides.join(shared, ["side", "k"])
        .withColumn("salts", salts)
        .withColumn("salt", F.pmod(F.xxhash64("row", "place"), F.col("salts")).cast("int"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("side", "k", "place", "low", "high", "salts", "salt")).alias("sides"))
    )
    # The same exchange of texts serves here and where the texts are cut.
    shown = source.join(open_.hint("shuffle_hash"), "row").select("doc_id", "row", "text", "sides").mapInArrow(_show_sides, SIDES)
    key = ["side", "k", "salt"]
    resolved = shown.repartition(*key).sortWithinPartitions(*key, "doc_id", "row", "place").mapInArrow(_resolve, FOUND)
    window = ["side", "k", "off", "w1", "w2"]
    hot = resolved.where("w1 is not null")
    earliest = (
        hot.groupBy(*window)
        .agg(F.min(F.struct("doc_id", "row", "start")).alias("f"), F.count("*").alias("n"))
        .where("n > 1")
    )
    later = hot.join(earliest, window).where("row != f.row or start != f.start")
    return (
        marked.where(F.col("place") == LOCAL)
        .select("row", F.col("low").alias("start"), F.col("high").alias("stop"))
        .union(marked.where(~F.col("first") & (F.col("place") != LOCAL)).select("row", "low", F.col("high") + LENGTH))
        .union(resolved.where("w1 is null").select("row", "start", "stop"))
        .union(later.select("row", "start", "stop"))
    )


def drop_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs``.

    Each byte is removed that lies in a string of 100 bytes that also starts earlier: in a row with a smaller doc_id
    (no doc_id is smallest; of rows with the same doc_id the first in table order), or in the same row further left.
    Overlaps count and strings are judged on the input. A null text is empty; texts under 100 bytes lose nothing; an
    empty table gives no rows; other columns are ignored. Rows are written once with their numbers and read from there.

    Every window of 100 bytes has an anchor, a 25-byte string in it that depends on its bytes only; about every 40th
    place of a text is one. Buckets start as those 25-byte strings and are refined by the buckets at later offsets:

    1. Buckets of anchors are counted; an anchor alone in its bucket has no repeated window. Only buckets move.
    2. For the others, the bytes that their windows reach get a digest (blake2b, 128 bits). Of anchors with equal ones
       the first stays in question and the others' windows are repeats at once. Each slice of a task combines its own
       first, so that a passage in very many documents sends one row per slice.
    3. Buckets of the first ones are refined to 63 bytes on either side; only sides that share them with other bytes
       go on. Their bytes, 138 at most, meet by bucket, and the windows in them are refined to all their 100 bytes, the
       first of equal ones being the original. A bucket of more than ``GROUP`` sides is salted, and the salts' first
       windows are merged once more by digests of their bytes.
    """
    python_ready(docs.sparkSession)
    source = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")), "substr-docs", "row")
    # Every row has a number; said here, both joins below read texts alike and share their exchange.
    source = source.where("row is not null")
    cuts = repeated_intervals(source).groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("cuts"))
    joined = source.join(cuts.hint("shuffle_hash"), "row", "left").select("doc_id", "text", "cuts")
    return joined.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
