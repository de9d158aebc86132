"""Plain versions of the operators, one loop each, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash

from cartwheel.llm import near


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def exact(pairs):
    groups = defaultdict(list)
    for doc_id, text in pairs:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), sha(text)) for i in ids]
    return out


def bench_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def contamination(pairs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = bench_words(text)
        k = min(13, len(words))
        for s in range(len(words) - k + 1 if k else 0):
            windows[tuple(words[s : s + k])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in pairs:
        words = bench_words(text)
        hit, found = set(), set()
        for k in sizes:
            for s in range(len(words) - k + 1):
                names = windows.get(tuple(words[s : s + k]))
                if names:
                    hit.update(range(s, s + k))
                    found |= names
        n = len(hit)
        out.append((doc_id, len(words), n, len(found), sha(",".join(sorted(found))), n > 0 and 20 * n >= len(words)))
    return out


def fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(pairs):
    marks = [fingerprint(t) for _, t in pairs]
    distinct = sorted(set(marks))
    parent = {m: m for m in distinct}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[top(a)] = top(b)
    least = {}
    for (doc_id, _), m in zip(pairs, marks):
        if doc_id is not None:
            least[top(m)] = min(least.get(top(m), doc_id), doc_id)
    return [(i, f"{m:016x}", least.get(top(m))) for (i, _), m in zip(pairs, marks)]


def near_left(pairs, radius=52):
    """doc_ids left: the least of each group of wide fingerprints linked through any chain."""
    marks = near.text_marks(pa.array([t or "" for _, t in pairs]))
    bits = np.unpackbits(marks.view(np.uint8), axis=1).astype(np.int32)
    left, todo = [], np.arange(len(pairs))
    while len(todo):
        group, front, todo = [todo[0]], [todo[0]], todo[1:]
        while front:
            close = (bits[todo] != bits[front.pop()]).sum(1) <= radius
            group += todo[close].tolist()
            front += todo[close].tolist()
            todo = todo[~close]
        left.append(min(pairs[i][0] for i in group))
    return sorted(left)
