"""Benchmark decontamination by a prefix-filtered set join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import bitmap, in_bitmap, python_ready, row_key, slices, texts, unused, written

WINDOW, SHINGLE = 13, 5
#: Bytes that separate words become blanks, A-Z become a-z; digits, a-z and bytes of other characters stay.
TABLE = bytes(b if chr(b).isdigit() and b < 128 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Words:
    """The words of several texts, found and hashed in array passes over one buffer.

    A word's hash is that of its bytes as a polynomial over 64-bit wrap-around numbers, mixed with its length. Hashes
    only propose; texts are compared word by word before anything counts.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, texts: list[bytes]):
        self.raw = b" ".join([*texts, b""]).translate(TABLE)
        held = np.frombuffer(self.raw, np.uint8)
        inside = np.r_[False, held != 32, False]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        bounds = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
        #: First word of each text, and the number of all words at the end.
        self.first = np.r_[0, np.searchsorted(self.starts, bounds)]
        inverse = pow(self.BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            powers, back = (np.cumprod(np.full(len(held) + 1, x, np.uint64)) for x in (self.BASE, inverse))
            upto = np.r_[np.uint64(0), np.cumsum((held.astype(np.uint64) + np.uint64(1)) * powers[:-1])]
            value = (upto[self.ends] - upto[self.starts]) * back[self.starts]
            self.hashes = (value ^ (value >> np.uint64(29))) * M2 + (self.ends - self.starts).astype(np.uint64)

    def tokens(self, size: int):
        """Place of the first word and hash of each run of ``size`` words of one text."""
        tokens = shingles(self.hashes, size)
        owner = np.searchsorted(self.first, np.arange(len(self.hashes)), side="right")
        places = np.flatnonzero(owner[: len(tokens)] == owner[size - 1 :][: len(tokens)])
        return places, tokens[places]

    def joined(self, low: int, high: int) -> str:
        """Words low..high-1, joined by blanks."""
        if high <= low:
            return ""
        return b" ".join(self.raw[self.starts[low] : self.ends[high - 1]].split()).decode()


def _words_of_slice(column) -> Words:
    return Words([text.as_buffer().to_pybytes() for text in column])


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(size), np.uint64)
    for i in range(size):
        out = (out ^ hashes[i : i + n]) * M1
        out = (out ^ (out >> np.uint64(31))) * M2
    return out ^ (out >> np.uint64(33))


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """item, window (its words joined by blanks), length, offset and hash of each of its shingles.

    A window is ``window`` words, or the whole item if it has fewer; shingles are shorter where the window is.
    """

    def run(batches):
        for part in slices(batches):
            rows, words = [], _words_of_slice(part.column("text"))
            for item, low, high in zip(part.column("item").to_pylist(), words.first[:-1].tolist(), words.first[1:].tolist()):
                length = min(window, high - low)
                size = min(shingle, length)
                if not length:
                    continue
                tokens = shingles(words.hashes[low:high], size).view(np.int64).tolist()
                for start in range(high - low - length + 1):
                    joined = words.joined(low + start, low + start + length)
                    for offset in range(length - size + 1):
                        rows.append((item, joined, length, offset, size, tokens[start + offset]))
                    if len(rows) > 20_000:
                        yield batch(rows)
                        rows = []
            yield batch(rows)

    def batch(rows):
        columns = list(zip(*rows)) if rows else [[]] * 6
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        names = ["item", "window", "length", "offset", "size", "key"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    source = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return source.mapInArrow(run, "item string, window string, length int, offset int, size int, key long")


def _count_tokens(sizes, wanted):
    """Per document its number of words, and how often each benchmark token occurs in the task's documents."""

    def run(batches):
        marks = wanted.value
        for part in slices(batches):
            words = _words_of_slice(part.column("text"))
            counts = np.diff(words.first)
            found = [words.tokens(size)[1] for size in sizes]
            found = [tokens[in_bitmap(marks, tokens)] for tokens in found]
            token, often = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            n, m = len(counts), len(token)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([part.column("doc"), pa.nulls(m, part.column("doc").type)]),
                    pa.concat_arrays([part.column("doc_id"), pa.nulls(m, pa.int64())]),
                    pa.concat_arrays([pa.array(counts, pa.int64()), pa.nulls(m, pa.int64())]),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(token.view(np.int64))]),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(often.astype(np.int64))]),
                ],
                names=["doc", "doc_id", "n_words", "key", "often"],
            )

    return run


def _find_tokens(sizes, wanted, reach: int):
    """Each occurrence of a prefix token with ``reach`` words around it, enough for any window that holds it."""

    def run(batches):
        marks = wanted.value
        for part in slices(batches):
            rows, docs, words = [], part.column("doc").to_pylist(), _words_of_slice(part.column("text"))
            first = words.first.tolist()
            for size in sizes:
                places, tokens = words.tokens(size)
                hit = np.flatnonzero(in_bitmap(marks, tokens))
                owners = np.searchsorted(words.first, places[hit], side="right") - 1
                for at, token, doc in zip(places[hit].tolist(), tokens[hit].view(np.int64).tolist(), owners.tolist()):
                    low, high = max(first[doc], at - reach), min(first[doc + 1], at + reach + 1)
                    rows.append((docs[doc], token, size, at - first[doc], at - low, first[doc + 1] - first[doc], words.joined(low, high)))
                    if len(rows) > 20_000:
                        yield batch(rows)
                        rows = []
            yield batch(rows)

    def batch(rows):
        columns = list(zip(*rows)) if rows else [[]] * 7
        kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())
        names = ["doc", "key", "size", "at", "before", "n_words", "around"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted ids as text), one row per row of ``docs``.

    Words are runs of 0-9, a-z (A-Z lower-cased) and characters beyond ASCII. A document word counts as hit if it lies
    in any occurrence of ``window`` consecutive words of an item; an item of fewer words, but not none, is one window.
    Null texts have no words; an item without an id has the empty id, items with the same id count once. Empty tables
    give no rows (``docs``) or no hits (``items``); repeated rows give repeated rows; other columns are ignored.

    1. Each window's tokens are its word shingles. One pass counts the benchmark's tokens in all documents.
    2. A document that holds a window holds all its tokens, so the rarest one is prefix enough: it is looked for in
       all documents in a second pass and joined to the windows that have it as their prefix.
    3. Occurrences whose window would begin before or end behind the document are dropped (positions and length);
       the rest is verified word by word on the words around the token.
    Texts never move: only token counts and words around prefix tokens are shuffled. Windows are joined, not
    broadcast by hand; tasks hold a bitmap of at most 16 MB, in which foreign tokens only cost a failed join.
    """
    spark = docs.sparkSession
    python_ready(spark)
    parts = written(item_windows(items, window, shingle), "decontam-windows")
    tokens = parts.select("key", "window", "offset", "size", "length").distinct()
    sizes = sorted(r[0] for r in parts.select("size").distinct().collect())
    source = texts(docs).withColumn("doc", row_key())

    wanted = spark.sparkContext.broadcast(bitmap(written(parts.select("key").distinct(), "decontam-keys")))
    counted = written(
        source.mapInArrow(_count_tokens(sizes, wanted), "doc binary, doc_id long, n_words long, key long, often long"),
        "decontam-counts",
    )
    often = counted.where("key is not null").groupBy("key").agg(F.sum("often").alias("often"))
    # A token that never occurs rules its window out.
    rarest = F.min(F.struct(F.coalesce("often", F.lit(0).cast("long")).alias("often"), "key", "offset")).alias("r")
    prefix = written(
        tokens.join(often, "key", "left")
        .groupBy("window", "size", "length")
        .agg(rarest)
        .where("r.often > 0")
        .select("window", "size", "length", F.col("r.key").alias("key"), F.col("r.offset").alias("offset")),
        "decontam-prefix",
    )
    marks = spark.sparkContext.broadcast(bitmap(written(prefix.select("key").distinct(), "decontam-prefix-keys")))
    found = source.mapInArrow(
        _find_tokens(sizes, marks, window - 1),
        "doc binary, key long, size int, at int, before int, n_words int, around string",
    )
    start = F.col("at") - F.col("offset")
    verified = written(
        found.join(prefix, ["key", "size"])
        .withColumn("start", start)
        .where("start >= 0 and start + length <= n_words")
        .where(
            F.array_join(F.expr("slice(split(around, ' '), greatest(1, before - offset + 1), length)"), " ") == F.col("window")
        )
        .select("doc", "start", "length", "window")
        .distinct(),
        "decontam-verified",
    )
    in_order = Window.partitionBy("doc").orderBy("start")
    end = F.col("start") + F.col("length")
    covered = F.max(end).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    hits = (
        verified.groupBy("doc", "start")
        .agg(F.max("length").alias("length"))
        .select("doc", F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(covered, F.lit(0)))).alias("new"))
        .groupBy("doc")
        .agg(F.sum("new").cast("long").alias("n_hit"))
    )
    occurring = (
        verified.select("doc", "window")
        .distinct()
        .join(parts.select("window", "item").distinct(), "window")
        .groupBy("doc")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    none = F.array().cast("array<string>")
    return (
        counted.where("key is null")
        .select("doc", "doc_id", "n_words")
        .join(hits.join(occurring, "doc"), "doc", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce(F.size("items").cast("long"), F.lit(0).cast("long")).alias("n_items"),
            F.coalesce("items", none).alias("items"),
            "doc",
        )
    )


def is_contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows, all columns kept."""
    key = unused(docs, "__doc")
    bad = contamination(docs, items).where(is_contaminated()).select(F.col("doc").alias(key)).distinct()
    return docs.withColumn(key, row_key()).join(bad, key, "left_anti").drop(key)
