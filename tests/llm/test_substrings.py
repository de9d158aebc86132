"""Repeated 100-byte strings against a plain loop over all windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from small import docs_of, other_splits, stored  # noqa: F401 - fixtures

from cartwheel.llm import queries, substrings


def plain(pairs):
    """pairs in table order."""
    order = sorted(range(len(pairs)), key=lambda i: (pairs[i][0] is not None, pairs[i][0] or 0, i))
    seen, out = set(), []
    for i in order:
        raw = (pairs[i][1] or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for s in range(len(raw) - 99):
            window = raw[s : s + 100]
            if window in seen:
                gone[s : s + 100] = True
            seen.add(window)
        runs = int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()) if len(raw) else 0
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((pairs[i][0], len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(df, pairs):
    assert sorted(map(tuple, df.collect()), key=repr) == plain(pairs)


def test_made_passages(stored):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("etaoinshrdé") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = [text(30) for _ in range(4)]
    pairs = []
    for i in range(150):
        parts = [text(rng.randint(0, 30)) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(passage)[rng.randint(0, 30) :])
        if rng.random() < 0.3:
            parts.append(parts[0])
        pairs.append((i, rng.choice(["", " "]).join(parts)))
    pairs += [(200 + i, pairs[i % 7][1]) for i in range(30)]
    base = pairs[3][1]
    pairs += [(300 + i, base[: rng.randrange(len(base))] + "#" + base[rng.randrange(len(base)) :]) for i in range(40)]
    pairs += [(400, None), (401, ""), (402, "a" * 99), (403, "a" * 100), (404, "a" * 101), (405, "a" * 5000), (406, "ab" * 700), (407, "a" * 99)]
    pairs += [(7, pairs[50][1]), (7, pairs[50][1]), (None, pairs[60][1]), (500, "é" * 4000)]
    rng.shuffle(pairs)
    for parts in (1, 5):
        docs = stored(pairs, parts)
        check(substrings.drop_repeats(docs), [(r.doc_id, r.text) for r in docs.collect()])


def test_cuts_hold_if_the_second_scan_is_dealt_otherwise(stored, other_splits):
    passage = "a passage that several documents repeat word for word, of more than a hundred bytes in all, " * 2
    docs = stored([(i, f"{i * 7919} starts {'x' * (i % 5)} {passage if i % 3 else i} and ends with {i * 104729}") for i in range(60)], 6)
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    cut = substrings.drop_repeats(docs)
    other_splits()
    check(cut, pairs)


def test_hot_bucket_is_salted(stored, monkeypatch):
    monkeypatch.setattr(substrings.repeated_intervals, "__defaults__", (4,))
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(160))
    text = lambda: "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 120)))
    pairs = [(i, text() + passage[rng.randint(0, 20) :] + text()) for i in range(120)]
    check(substrings.drop_repeats(stored(pairs, 7)), pairs)


def test_empty(stored):
    assert substrings.drop_repeats(stored([])).count() == 0
    check(substrings.drop_repeats(stored([(1, None), (2, "x")])), [(1, None), (2, "x")])


def test_small_slices(stored, monkeypatch):
    monkeypatch.setattr(substrings.slices, "__defaults__", ("text", 500))
    text = "".join(chr(97 + (i * i) % 26) for i in range(3000))
    pairs = [(i, text[i * 7 : 900 + i * 13]) for i in range(40)]
    check(substrings.drop_repeats(stored(pairs)), pairs)


def test_on_table(spark, sf_dir):
    pairs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(queries.QUERIES["op8_suffix_dedup"](spark, sf_dir), pairs)


@pytest.mark.parametrize("n", [100, 101, 131, 1000])
def test_gram_buckets_name_equal_strings(n):
    raw = np.random.default_rng(n).integers(0, 2, n).astype(np.uint8)
    buckets = substrings.gram_buckets(raw)
    assert len(buckets) == n - 24
    strings = [raw[i : i + 25].tobytes() for i in range(n - 24)]
    assert len(set(zip(strings, buckets.tolist()))) == len(set(strings)) == len(set(buckets.tolist()))


def undo(mixed, later):
    """First argument of ``refine`` from its result and the second one."""
    x, every = int(mixed), (1 << 64) - 1
    x ^= x >> 29 ^ x >> 58
    x = x * pow(int(substrings.M3), -1, 1 << 64) & every
    x ^= x >> 32
    x = x * pow(int(substrings.M1), -1, 1 << 64) & every
    return x ^ ((int(later) * int(substrings.M2) & every) + (int(later) >> 29) & every)


def test_texts_made_to_share_buckets_are_different(stored):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n)).encode()

    def other(gram):
        """Another 25 ASCII bytes with the same bucket."""
        want = int(substrings.gram_buckets(np.frombuffer(gram + bytes(20), np.uint8))[0])
        while True:
            tail = text(17)
            e8, e16, e17 = (int.from_bytes(tail[i : i + 8], "little") for i in (0, 8, 9))
            both = undo(want, e17)
            one = int(substrings.refine(np.array([e8], np.uint64), np.array([e16], np.uint64))[0])
            head = undo(undo(both, one), e8).to_bytes(8, "little")
            if max(head) < 128 and min(head) > 31:
                made = head + tail
                assert int(substrings.gram_buckets(np.frombuffer(made + bytes(20), np.uint8))[0]) == want
                return made

    pairs = []
    for i in range(0, 40, 2):
        base = text(100)
        pairs += [(i, base.decode()), (i + 1, (base[:75] + other(base[75:])).decode())]
    got = substrings.drop_repeats(stored(pairs)).collect()
    assert all(r.n_removed == 0 for r in got) and len({t for _, t in pairs}) == 40
