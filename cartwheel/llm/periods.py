"""Periodic runs: stretches of words that repeat with a fixed lag."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import python_ready, slices, whole_text
from cartwheel.llm.words import Words, joined

LEAST, TIMES = 6, 4
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _diagonals(at: np.ndarray, lag: np.ndarray, doc: np.ndarray):
    """Maximal stretches of neighbouring places of one document with the same lag: first and last index into ``at``."""
    new = np.r_[True, (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1]) | (doc[1:] != doc[:-1])]
    first = np.flatnonzero(new)
    return first, np.r_[first[1:], len(at)] - 1


def runs(symbols: np.ndarray, counts: np.ndarray, least: int = LEAST, times: int = TIMES):
    """document, start, length and period of every run in the words of all documents, sorted by document, start, period.

    A run has length >= max(``least``, ``times`` * period), with ``least`` > 2 and ``times`` >= 4. The diagonal of a lag
    is a stretch of places whose symbol occurred that lag earlier; its match length grows with each such place and
    where it ends with a sufficient length, the run is there. Word by word, all earlier occurrences would count, which
    is quadratic for a frequent word. So lags above k/2 up to k are read off the strings of k words (k = 1, 2, 4, ...)
    instead of words: within a run whose period is at most k, the latest earlier occurrence of such a string lies
    exactly one period back, for its smallest period is not the smaller lag that a nearer one would show. Hence one
    active lag per place and k. Strings that occur once in their document are dropped before k doubles, so the work
    follows what repeats, and a text of one word repeated costs a sort for each k.
    """
    starts = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(counts)), counts)
    # A symbol names the string of k words at a place, within its document.
    at = np.arange(len(symbols))
    name = symbols * len(counts) + doc
    found = []
    k = 1
    while len(at):
        order = np.argsort(name, kind="stable")
        sorted_name, sorted_at = name[order], at[order]
        same = sorted_name[1:] == sorted_name[:-1]
        lag = np.zeros(len(at), np.int64)
        lag[order[1:]] = np.where(same, sorted_at[1:] - sorted_at[:-1], 0)
        hit = np.flatnonzero((lag > k // 2) & (lag <= k))
        if len(hit):
            first, last = _diagonals(at[hit], lag[hit], doc[at[hit]])
            period, begin = lag[hit][first], at[hit][first]
            length = at[hit][last] - begin + k + period
            long = length >= np.maximum(least, times * period)
            of = doc[begin[long]]
            found.append((of, begin[long] - period[long] - starts[of], length[long], period[long]))
        # On to 2k words: only places where both halves repeat, in documents long enough for a longer period.
        again = np.zeros(len(at), bool)
        again[1:] |= same
        again[:-1] |= same
        groups = np.cumsum(np.r_[True, ~same]) - 1
        number = np.full(len(symbols) + 1, -1, np.int64)
        number[sorted_at[again]] = groups[again]
        at = np.sort(sorted_at[again])
        at = at[counts[doc[at]] >= times * (k + 1)]
        at = at[(at + k < len(symbols))]
        at = at[(number[at + k] >= 0) & (doc[at + k] == doc[at])]
        name = number[at] * (int(groups[-1]) + 1) + number[at + k]
        k *= 2
    of, start, length, period = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(4))
    order = np.lexsort((period, start, of))
    return of[order], start[order], length[order], period[order]


def _find(least: int, times: int):
    def run(batches):
        for batch in slices(batches):
            words = Words(batch.column("text"))
            symbols, _ = words.symbols()
            of, start, length, period = runs(symbols, words.counts, least, times)
            base = (np.cumsum(words.counts) - words.counts)[of] + start
            depth = np.zeros(len(symbols) + 1, np.int64)
            np.add.at(depth, base + period, 1)
            np.add.at(depth, base + length, -1)
            kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
            doc = np.repeat(np.arange(len(words.counts)), words.counts)
            left = np.bincount(doc[kept], minlength=len(words.counts))
            listed = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(RUN))
            offsets = np.r_[0, np.cumsum(np.bincount(of, minlength=len(words.counts)))].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(words.counts.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), listed),
                    joined(words.strings.take(pa.array(kept)), left),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return run


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs (start, length, period, by start then period) and collapsed of every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch with smallest period q and at least
    max(``least``, ``times`` * q) words that no neighbouring word extends. ``collapsed`` is the text without the words
    that some run contains behind its first q, joined by one space. A null text is empty; a text without words gives
    no runs and an empty ``collapsed``; repeated rows give a row each, an empty table none; other columns are ignored.
    Texts are worked on in slices of bounded size, or one by one where a text is larger than that; nothing is shuffled.
    """
    if least < 3 or times < 4:
        raise ValueError("runs need least >= 3 and times >= 4")
    python_ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(_find(least, times), SCHEMA)


def best_run(runs_column: str = "runs"):
    """The run with the greatest exact length / period; of equal ones the first by start, then period; null if none."""
    kind = "struct<start:bigint,length:bigint,period:bigint>"
    return F.expr(
        f"aggregate({runs_column}, cast(null as {kind}), (b, r) -> "
        "CASE WHEN b IS NULL OR r.length * b.period > b.length * r.period THEN r ELSE b END)"
    )
