"""Periodic runs against a plain diagonal-by-diagonal search."""

from __future__ import annotations

import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from brute import sha
from small import docs_of  # noqa: F401

from cartwheel.llm import periods, queries
from cartwheel.llm.words import Words


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def plain_runs(words):
    """Every lag on its own: maximal stretches of matches, longest first by lag, kept if no smaller period fits."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if j > i and length >= max(6, 4 * q):
                part = words[start:j]
                if not any(all(part[x] == part[x - p] for x in range(p, length)) for p in range(1, q)):
                    out.append((start, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, rewritten=True):
    words = words_of(text)
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if rewritten and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None, None, None)
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_random_texts_against_plain():
    rng = np.random.default_rng(7)
    texts = []
    for n, letters in [(0, 1), (1, 1), (5, 1), (6, 1), (40, 1), (60, 2), (60, 2), (90, 3), (200, 2), (300, 2)] * 6:
        base = rng.integers(0, letters, n)
        if n > 30:
            for _ in range(3):
                q, at = int(rng.integers(1, 9)), int(rng.integers(0, n - 20))
                stop = min(n, at + int(rng.integers(3, 7)) * q)
                for i in range(at + q, stop):
                    base[i] = base[i - q]
        texts.append(base.astype(np.int64))
    counts = np.array([len(t) for t in texts])
    of, start, length, period = periods.runs(np.concatenate(texts), counts)
    for d, t in enumerate(texts):
        got = [tuple(map(int, r)) for r in zip(start[of == d], length[of == d], period[of == d])]
        assert got == plain_runs(t.tolist()), (d, t.tolist())


def test_runs_within_runs_and_across_documents():
    inner = "a a a a a a a b ".split() * 4
    of, start, length, period = periods.runs(np.unique(inner, return_inverse=True)[1].astype(np.int64), np.array([len(inner)]))
    assert sorted(zip(period.tolist(), length.tolist())) == [(1, 7)] * 4 + [(8, 32)]
    # The same word at the end of one document and the start of the next is no run.
    assert len(periods.runs(np.zeros(8, np.int64), np.array([4, 4]))[0]) == 0


def test_one_word_repeated_is_quick():
    n = 2_000_000
    of, start, length, period = periods.runs(np.zeros(n, np.int64), np.array([n]))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [n], [1])


@pytest.mark.parametrize("stops", [False, True])
def test_words_of_slices(stops):
    import pyarrow as pa

    texts = ["a b", "", None, " c\té.", "d.", ". e,", "f g\x1c", "h,\n\ni..", "j"]
    words = Words(pa.array(texts), stops)
    want = [words_of(t) for t in texts]
    if stops:
        cut = re.compile(r".*[A-Za-z0-9][.,;:!?]")
        want = [[x for w in ws for x in ([w[:-1], w[-1]] if cut.fullmatch(w) else [w])] for ws in want]
    assert words.strings.to_pylist() == [w for ws in want for w in ws]
    assert words.counts.tolist() == [len(ws) for ws in want]


def test_edges(docs_of):
    pairs = [(1, None), (2, ""), (3, " \n"), (4, "x " * 6), (4, "x " * 6), (None, "y z " * 5), (5, "u " * 50_000)]
    got = periods.find_runs(docs_of(pairs)).collect()
    assert len(got) == len(pairs)
    by = {r.doc_id: r for r in got}
    assert by[1].runs == by[2].runs == by[3].runs == [] and by[1].collapsed == by[3].collapsed == ""
    assert [tuple(r) for r in by[4].runs] == [(0, 6, 1)] and by[4].collapsed == "x"
    assert [tuple(r) for r in by[None].runs] == [(0, 10, 2)] and by[None].collapsed == "y z"
    assert [tuple(r) for r in by[5].runs] == [(0, 50_000, 1)]
    assert periods.find_runs(docs_of([])).count() == 0


def test_best_is_by_exact_ratio(spark):
    runs = [(0, 12, 3), (20, 9, 2), (40, 18, 4), (60, 9, 2)]
    df = spark.createDataFrame([(runs,), ([],)], "runs array<struct<start:bigint,length:bigint,period:bigint>>")
    got = [r.b for r in df.select(periods.best_run().alias("b")).collect()]
    assert tuple(got[0]) == (20, 9, 2) and got[1] is None


def test_query_against_plain(spark, sf_dir):
    got = queries.QUERIES["op11_periodic_runs"](spark, sf_dir)
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.select(*names).collect()), key=lambda r: r[0]) == sorted(plain_row(*d) for d in docs)
    assert got.where("n_runs > 0").count() > 5


def test_query_handles_nulls(docs_of):
    got = {r.doc_id: r for r in queries.periodic_runs(docs_of([(None, "a " * 9), (17, None), (18, "a b " * 9)])).collect()}
    assert got[None].n_runs == 1 and got[17].n_runs == 0 and got[17].start is None
    assert tuple(got[18])[:8] == plain_row(18, "a b " * 9)
