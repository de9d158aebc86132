"""Quality scores: averaged vectors of hashed words and character n-grams, softmax output, trained in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import python_ready, row_key, slices, texts, unused, whole_text

THRESHOLD = 0.3
FOLDS = 5
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Settings:
    """``sample`` is the documented bound of training documents; everything else about a model is fixed by its size."""

    sample: int = 1500
    buckets: int = 1 << 16
    dim: int = 12
    grams: tuple[int, ...] = (3, 4)
    steps: int = 900
    batch: int = 16
    rate: float = 2.0
    seed: int = 17


def _mix(a, b):
    x = (a ^ b) * M1
    x = (x ^ (x >> np.uint64(29))) * M2
    return x ^ (x >> np.uint64(32))


class Words:
    """Feature buckets of words; each distinct word is looked at once, while at most ``most`` of them are kept."""

    def __init__(self, settings: Settings, most: int = 200_000):
        self.settings, self.most = settings, most
        self.forget()

    def forget(self):
        self.number: dict[str, int] = {}
        self.hashes = np.zeros(0, np.uint64)

    def codes(self, items: list[str]):
        """Number of each word of each text, flat; words per text; the words seen for the first time."""
        number, known = self.number, len(self.number)
        codes, counts = [], []
        for text in items:
            words = text.split()
            got = list(map(number.get, words))
            if None in got:
                got = [number.setdefault(w, len(number)) for w in words]
            codes += got
            counts.append(len(words))
        fresh = list(number)[known:] if len(number) > known else []
        return np.array(codes, np.int64), np.array(counts, np.int64), fresh

    def features(self, fresh: list[str]):
        """Buckets of the n-grams of <word>, then of the word itself: flat, with the number for each word."""
        code = np.frombuffer("".join(f"<{w}>" for w in fresh).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        sizes = np.fromiter((len(w) + 2 for w in fresh), np.int64, len(fresh))
        starts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(fresh)), sizes)
        place = np.arange(len(code)) - starts[owner]
        # A word's own hash is a sum over its places, so that words of any length take one pass.
        whole = np.add.reduceat(_mix(code * M2, (place + 1).astype(np.uint64) * M1), starts)
        self.hashes = np.r_[self.hashes, whole]
        found, owners = [whole], [np.arange(len(fresh))]
        rolling = _mix(code, np.uint64(7))
        for n in range(2, max(self.settings.grams) + 1):
            rolling = _mix(rolling[:-1] * M2, code[n - 1 :]) if len(rolling) > 1 else rolling[:0]
            if n in self.settings.grams:
                inside = place[: len(rolling)] + n <= sizes[owner[: len(rolling)]]
                found.append(rolling[inside] ^ np.uint64(n))
                owners.append(owner[: len(rolling)][inside])
        owners = np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        buckets = (np.concatenate(found)[order] >> np.uint64(20)) % np.uint64(self.settings.buckets)
        return buckets.astype(np.int64), np.bincount(owners, minlength=len(fresh))

    def pairs(self, codes: np.ndarray, counts: np.ndarray):
        """Bucket of each word with the one before it. A word that repeats the one before has a bucket of its own kind."""
        if not len(codes):
            return codes, counts * 0
        follows = np.ones(len(codes), bool)
        starts = (np.cumsum(counts) - counts)[counts > 0]
        follows[starts] = False
        at = np.flatnonzero(follows)
        mixed = _mix(self.hashes[codes[at - 1]] * M2, self.hashes[codes[at]])
        mixed[codes[at - 1] == codes[at]] = np.uint64(1)
        return (mixed % np.uint64(self.settings.buckets)).astype(np.int64), np.maximum(counts - 1, 0)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows, ``sizes[i]`` of them for sum i; zero for none."""
    out = np.zeros((len(sizes), values.shape[1]), np.float64)
    some = sizes > 0
    if some.any():
        out[some] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[some], axis=0)
    return out


def bags(items: list[str], settings: Settings):
    """Distinct feature buckets of each text, and how often it has each."""
    words, known = Words(settings, most=1 << 62), []
    for text in items:
        codes, counts, fresh = words.codes([text])
        if fresh:
            buckets, sizes = words.features(fresh)
            known += np.split(buckets, np.cumsum(sizes)[:-1])
        flat = [known[c] for c in codes.tolist()] + [words.pairs(codes, counts)[0]]
        yield np.unique(np.concatenate(flat), return_counts=True)


def train(items: list[str], labels: np.ndarray, settings: Settings):
    """``descend`` on the bags of whole texts."""
    return descend(list(bags(items, settings)), labels, settings)


def descend(counted: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, settings: Settings):
    """Vectors and output weights by minibatch gradient descent. The same bags in the same order give the same model."""
    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-1, 1, (settings.buckets, settings.dim)) / settings.dim
    output, bias = np.zeros((settings.dim, 2)), np.zeros(2)
    target = np.eye(2)[labels]
    step = 0
    while step < settings.steps:
        order = random.permutation(len(counted))
        for start in range(0, len(order), settings.batch):
            if step == settings.steps:
                break
            chosen = order[start : start + settings.batch]
            # Shares are worked out for a batch at a time: the sample's counts are all that stays on the driver.
            rows = [(feature, often / max(1, often.sum())) for feature, often in (counted[i] for i in chosen)]
            rate = settings.rate * (1 - step / settings.steps)
            step += 1
            feature = np.concatenate([r[0] for r in rows])
            weight = np.concatenate([r[1] for r in rows])
            sizes = np.array([len(r[0]) for r in rows])
            hidden = _sums(vectors[feature] * weight[:, None], sizes)
            error = _softmax(hidden @ output + bias) - target[chosen]
            back = error @ output.T
            owner = np.repeat(np.arange(len(chosen)), sizes)
            output -= rate * hidden.T @ error
            bias -= rate * error.sum(0)
            place, slot = np.unique(feature, return_inverse=True)
            for d in range(settings.dim):
                vectors[place, d] -= rate * np.bincount(slot, weight * back[owner, d], len(place))
    return vectors.astype(np.float32), output, bias


def _softmax(x):
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


class Scorer:
    """Scores lists of texts with a trained model."""

    def __init__(self, model, settings: Settings):
        self.vectors, self.output, self.bias = model
        self.words = Words(settings)
        self._forget()

    def _forget(self):
        self.words.forget()
        self.word_sums, self.word_sizes = np.zeros((0, self.vectors.shape[1]), np.float32), np.zeros(0, np.int64)

    def score(self, items: list[str]) -> np.ndarray:
        if len(self.words.number) > self.words.most:
            self._forget()
        codes, counts, fresh = self.words.codes(items)
        if fresh:
            buckets, sizes = self.words.features(fresh)
            self.word_sums = np.r_[self.word_sums, _sums(self.vectors[buckets], sizes).astype(np.float32)]
            self.word_sizes = np.r_[self.word_sizes, sizes]
        pairs, pair_counts = self.words.pairs(codes, counts)
        total = _sums(self.word_sums[codes], counts) + _sums(self.vectors[pairs], pair_counts)
        size = _sums(self.word_sizes[codes][:, None], counts)[:, 0] + pair_counts
        return _softmax(total / np.maximum(size, 1)[:, None] @ self.output + self.bias)[:, 1]


def in_held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by five; no id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()):
    """Train on at most ``settings.sample`` labelled documents outside the held-out fold.

    The sample is those with the smallest hash of (doc_id, text); whole texts are used. What the driver sees of a text
    are its bucket counts, at most ``settings.buckets`` of them whatever its length. Labels that aren't 0 or 1 and
    labels without a document are left out, a document with both labels counts once for each. Without any sample the
    model gives 0.5 everywhere; with one class only it learns that class.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .where("label in (0, 1) and doc_id is not null")
        .where(~in_held_out(F.col("doc_id")))
        .distinct()
    )
    # Bounded ids first, so that only the sample's texts are looked at, in the tasks that read them; only ids of documents
    # count towards the bound.
    there = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    chosen = marks.join(there, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id", F.lit(settings.seed)), "doc_id", "label").limit(settings.sample)

    def run(batches):
        for part in slices(batches):
            found = list(bags(part.column("text").to_pylist(), settings))
            offsets = pa.array(np.cumsum([0, *(len(f) for f, _ in found)]), pa.int32())
            arrays = [pa.array(np.concatenate([bag[n] for bag in found]), pa.int32()) for n in (0, 1)]
            own = [part.column(c) for c in ("doc_id", "label", "mark")]
            lists = [pa.ListArray.from_arrays(offsets, a) for a in arrays]
            yield pa.RecordBatch.from_arrays([*own, *lists], names=["doc_id", "label", "mark", "feature", "often"])

    picked = (
        texts(docs)
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "label", F.xxhash64("text").alias("mark"), "text")
        .mapInArrow(run, "doc_id long, label int, mark long, feature array<int>, often array<int>")
        .orderBy(F.xxhash64("doc_id", F.lit(settings.seed)), "doc_id", "label", "mark")
        .limit(settings.sample)
        .select("label", "feature", "often")
        .toArrow()
    )
    if not picked.num_rows:
        return np.zeros((settings.buckets, settings.dim), np.float32), np.zeros((settings.dim, 2)), np.zeros(2)
    feature, often = (
        [row.values.to_numpy() for row in picked.column(c)] for c in ("feature", "often")
    )
    return descend(list(zip(feature, often)), picked.column("label").to_numpy().astype(np.int64), settings)


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold), one row per row of ``docs``.

    A null text is the empty text; a text without words gets the score of the bias alone. Repeated rows give repeated
    rows, an empty table gives none, other columns are ignored. Scores depend on the text only.
    """
    score = scorer(docs, labels, settings)
    scored = texts(docs).mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id",
        in_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"),
    )


def scorer(docs: DataFrame, labels: DataFrame, settings: Settings, key: str = "doc_id"):
    """Function for mapInArrow that turns (key, text) into (key, score); the model is sent to the tasks once."""
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(fit(docs, labels, settings))

    def run(batches):
        model = Scorer(shared.value, settings)
        for part in slices(batches):
            scores = model.score(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(key), pa.array(scores, pa.float64())], names=[key, "score"])

    return run


def drop_low_quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score is below ``threshold``, all columns kept, rows with no text scored too.

    Verdicts are joined back on ``row_key``: rows that share id and text share their score.
    """
    key = unused(docs, "__row")
    placed = docs.withColumn(key, row_key())
    score = scorer(docs, labels, settings, "__row")
    low = (
        placed.select(F.col(key).alias("__row"), whole_text().alias("text"))
        .mapInArrow(score, "__row binary, score double")
        .where(F.col("score") < threshold)
        .select(F.col("__row").alias(key))
        .distinct()
    )
    return placed.join(low, key, "left_anti").drop(key)
