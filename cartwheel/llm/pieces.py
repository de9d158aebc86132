"""Subword pieces: encoding by vectorised merge rounds, and decoding."""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartwheel.llm.common import python_ready, slices, texts

SPACE = "▁"
#: A merge never joins a character other than SPACE with a following SPACE, so texts fall into these segments.
SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*")
HARDLY = np.int64(1) << 40


class Vocabulary:
    """The tables of a BPE model with byte fallback, read with the sentencepiece library; plain arrays and lists."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.end = model.eos_id()
        pieces = [model.id_to_piece(i) for i in range(size)]
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        plain = {p: i for i, p in enumerate(pieces) if i not in special and not model.is_unused(i)}
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        byte_of = {int(i): bytes([b]) for b, i in enumerate(self.byte_ids)}
        #: What an id is decoded to; SPACE becomes a blank.
        self.surface = [
            byte_of[i] if i in byte_of else b" \xe2\x81\x87 " if model.is_unknown(i) else b"" if i in special else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.byte_like = frozenset(byte_of)
        self.surface_bytes = np.frombuffer(b"".join(self.surface), np.uint8)
        self.surface_size = np.array(list(map(len, self.surface)), np.int64)
        self.surface_start = np.cumsum(self.surface_size) - self.surface_size
        self.blank_first = np.array([i not in special and p.startswith(SPACE) for i, p in enumerate(pieces)])
        self.char_ids = {p: i for p, i in plain.items() if len(p) == 1}
        scores = {p: model.get_score(i) for p, i in plain.items()}
        order = sorted(set(scores.values()), reverse=True)
        rank = {s: r for r, s in enumerate(order)}
        shared = np.bincount([rank[s] for p, s in scores.items() if len(p) > 1], minlength=len(order)) > 1
        left, right, merged = [], [], []
        for p, i in plain.items():
            for cut in range(1, len(p)):
                a, b = plain.get(p[:cut]), plain.get(p[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(i)
        #: Ranks of pieces; a rank that several pieces share allows one merge at a time.
        self.piece_rank = np.full(size, HARDLY, np.int64)
        for p, i in plain.items():
            self.piece_rank[i] = rank[scores[p]]
        self.shared_rank = shared
        #: Pieces that some pair of theirs outranks; only for these must a round look at what its merges bring about.
        self.outranked = np.zeros(size, bool)
        left, right, merged = np.array(left, np.int64), np.array(right, np.int64), np.array(merged, np.int64)
        for side in (left, right):
            self.outranked[side[self.piece_rank[merged] < self.piece_rank[side]]] = True
        self._hash_pairs(left, right, merged.astype(np.int32))

    def _hash_pairs(self, left, right, merged, bits: int = 19):
        """Open table for (left, right) -> merged piece; a pair that finds its slot taken tries the next hash."""
        keys = left << 20 | right
        self.table_bits = max(bits, (4 * len(keys)).bit_length())
        self.slots = np.full(1 << self.table_bits, -1, np.int64)
        self.values = np.full(1 << self.table_bits, -1, np.int32)
        rest, self.probes = np.arange(len(keys)), 0
        while len(rest):
            at = self._slot(keys[rest], self.probes)
            free = self.slots[at] == -1
            self.slots[at[free]] = keys[rest[free]]
            placed = self.slots[at] == keys[rest]
            self.values[at[placed]] = merged[rest[placed]]
            rest = rest[~placed]
            self.probes += 1

    def _slot(self, keys, probe):
        factor = 0x9E3779B97F4A7C15 * (2 * probe * probe + 1) & (1 << 64) - 1
        return ((keys.astype(np.uint64) * np.uint64(factor)) >> np.uint64(64 - self.table_bits)).astype(np.int64)

    def merge_of(self, left, right):
        """The merged piece of each pair of ids, or -1. Ids below zero are characters outside the vocabulary."""
        keys = left.astype(np.int64) << 20 | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -1
        found = np.full(len(keys), -1, np.int32)
        open_ = np.flatnonzero(keys >= 0)
        for probe in range(self.probes):
            at = self._slot(keys[open_], probe)
            there = self.slots[at]
            match = there == keys[open_]
            found[open_[match]] = self.values[at[match]]
            open_ = open_[~match & (there != -1)]
            if not len(open_):
                break
        return found


def _symbols(segments: list[str], vocab: Vocabulary):
    """Flat character ids (below zero: minus code point minus one) and the segment of each."""
    codes = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32).astype(np.int64)
    distinct, inverse = np.unique(codes, return_inverse=True)
    ids = np.array([vocab.char_ids.get(chr(c), -int(c) - 1) for c in distinct], np.int64)
    lengths = np.fromiter(map(len, segments), np.int64, len(segments))
    return ids[inverse], np.repeat(np.arange(len(segments)), lengths)


def merge_rounds(symbols: np.ndarray, owner: np.ndarray, vocab: Vocabulary):
    """Merge pairs until none is left. ``owner`` is the segment of each symbol, in rising order.

    Each round finds the best pair of every segment (segmented minimum of the pair ranks), merges its occurrences from
    the left without overlaps, all segments at once, and compacts; segments without a pair leave. A round merges only
    the leftmost occurrence where several pieces share the rank, or where a merge would make a better pair beside it,
    because that pair would come first.
    """
    done_symbols, done_owner = [], []
    inside = owner[1:] == owner[:-1]
    merged = np.full(len(symbols), -1, np.int64)
    merged[:-1] = np.where(inside, vocab.merge_of(symbols[:-1], symbols[1:]), -1)
    rank = np.where(merged >= 0, vocab.piece_rank[merged], HARDLY)
    starts = np.flatnonzero(np.r_[True, ~inside]) if len(symbols) else np.zeros(0, np.int64)
    lengths = np.diff(np.r_[starts, len(symbols)])
    while len(symbols):
        best = np.minimum.reduceat(rank, starts)
        open_ = best < HARDLY
        if not open_.all():
            go = np.repeat(open_, lengths)
            done_symbols.append(symbols[~go])
            done_owner.append(owner[~go])
            symbols, owner, merged, rank = symbols[go], owner[go], merged[go], rank[go]
            lengths, best = lengths[open_], best[open_]
            starts = np.cumsum(lengths) - lengths
            if not len(symbols):
                break
        hit = np.flatnonzero(rank == np.repeat(best, lengths))
        own = np.searchsorted(starts, hit, side="right") - 1
        first = np.r_[True, own[1:] != own[:-1]]
        # Overlapping occurrences form runs of neighbours: every second one, from the left, is merged.
        run = np.r_[True, np.diff(hit) != 1] | first
        run_start = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
        taken = (np.arange(len(hit)) - run_start) % 2 == 0
        one_by_one = vocab.shared_rank[best]
        risky = np.flatnonzero(vocab.outranked[merged[hit]])
        if len(risky):
            piece, at, of = merged[hit[risky]], hit[risky], own[risky]
            before, after = at > starts[of], at + 2 < starts[of] + lengths[of]
            for there, left, right in (
                (before, symbols[np.maximum(at - 1, 0)], piece),
                (after, piece, symbols[np.minimum(at + 2, len(symbols) - 1)]),
                (before | after, piece, piece),
            ):
                pair = vocab.merge_of(left, right)
                better = there & (pair >= 0) & (np.where(pair >= 0, vocab.piece_rank[pair], HARDLY) < best[of])
                one_by_one[of[better]] = True
        taken &= first | ~one_by_one[own]
        hit, own = hit[taken], own[taken]
        symbols[hit] = merged[hit]
        keep = np.ones(len(symbols), bool)
        keep[hit + 1] = False
        symbols, owner, merged, rank = symbols[keep], owner[keep], merged[keep], rank[keep]
        lengths -= np.bincount(own, minlength=len(lengths))
        starts = np.cumsum(lengths) - lengths
        # Only pairs with a merged symbol have changed.
        now = hit - np.arange(len(hit))
        touched = np.r_[now, now[now > starts[own]] - 1]
        ends = np.r_[starts[own] + lengths[own], (starts[own] + lengths[own])[now > starts[own]]]
        inside = touched + 1 < ends
        pair = vocab.merge_of(symbols[touched], symbols[np.minimum(touched + 1, len(symbols) - 1)])
        pair[~inside] = -1
        merged[touched] = pair
        rank[touched] = np.where(pair >= 0, vocab.piece_rank[pair], HARDLY)
    if not done_symbols:
        return symbols, owner
    symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    return symbols[order], owner[order]


def _with_bytes(symbols, owner, vocab):
    """Replace characters outside the vocabulary by the ids of their UTF-8 bytes."""
    unknown = symbols < 0
    if not unknown.any():
        return symbols.astype(np.int32), owner
    raw = {int(c): chr(-int(c) - 1).encode("utf-8", "surrogatepass") for c in np.unique(symbols[unknown])}
    size = np.ones(len(symbols), np.int64)
    size[unknown] = [len(raw[int(c)]) for c in symbols[unknown]]
    out = np.repeat(symbols, size)
    start = np.cumsum(size) - size
    for at, code in zip(start[unknown], symbols[unknown]):
        out[at : at + len(raw[int(code)])] = vocab.byte_ids[list(raw[int(code)])]
    return out.astype(np.int32), np.repeat(owner, size)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate values[start : start + length] of all pairs."""
    ends = np.cumsum(lengths)
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """Encodes lists of texts. Each distinct segment is merged once while at most ``most`` of them are kept."""

    def __init__(self, vocab: Vocabulary, most: int = 300_000):
        self.vocab, self.most = vocab, most
        self._forget()

    def _forget(self):
        # Segment 0 is the end id.
        self.number: dict[str, int] = {"": 0}
        self.symbols, self.lengths = np.array([self.vocab.end], np.int32), np.ones(1, np.int64)

    def encode(self, items: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, flat, and the number of ids of each text, the end id included."""
        if len(self.number) > self.most:
            self._forget()
        number, known = self.number, len(self.number)
        codes, counts = [], []
        for text in items:
            found = SEGMENT.findall(SPACE + text.replace(" ", SPACE)) if text else []
            got = list(map(number.get, found))
            if None in got:
                got = [number.setdefault(s, len(number)) for s in found]
            codes += got
            codes.append(0)
            counts.append(len(found) + 1)
        if len(number) > known:
            fresh = list(islice(reversed(number), len(number) - known))[::-1]
            symbols, owner = _with_bytes(*merge_rounds(*_symbols(fresh, self.vocab), self.vocab), self.vocab)
            self.symbols = np.r_[self.symbols, symbols]
            self.lengths = np.r_[self.lengths, np.bincount(owner, minlength=len(fresh))]
        starts = np.cumsum(self.lengths) - self.lengths
        every = np.array(codes, np.int64)
        sizes = self.lengths[every]
        upto = np.cumsum(sizes)[np.cumsum(counts) - 1] if counts else np.zeros(0, np.int64)
        return gather(self.symbols, starts[every], sizes), np.diff(np.r_[0, upto])


def decode_all(ids: np.ndarray, counts: np.ndarray, vocab: Vocabulary) -> list[str]:
    """Texts of flat ids, ``counts[i]`` of them for text i: pieces joined, byte ids read as UTF-8, and the blank in
    front of the first piece dropped."""
    sizes = vocab.surface_size[ids]
    raw = gather(vocab.surface_bytes, vocab.surface_start[ids], sizes).tobytes()
    upto = np.r_[0, np.cumsum(sizes)]
    ends = np.cumsum(counts)
    out = []
    for start, end in zip((ends - counts).tolist(), ends.tolist()):
        low, high = upto[start], upto[end]
        first = start
        while first < end and not sizes[first]:
            first += 1
        if first < end and vocab.blank_first[ids[first]]:
            low += 1
        try:
            out.append(raw[low:high].decode())
        except UnicodeDecodeError:
            out.append(_decode_broken(ids[start:end].tolist(), vocab))
    return out


def decode_ids(ids, vocab: Vocabulary) -> str:
    """Text of one list of ids."""
    return decode_all(np.array(ids, np.int64), np.array([len(ids)]), vocab)[0]


def _decode_broken(ids, vocab):
    """As decode_ids where runs of byte ids aren't UTF-8: each byte that begins no character becomes U+FFFD."""
    out, run = [], bytearray()

    def flush():
        while run:
            for size in (1, 2, 3, 4):
                try:
                    out.append(bytes(run[:size]).decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                size = 1
            del run[:size]

    begun = False
    for i in ids:
        if i in vocab.byte_like:
            run.extend(vocab.surface[i])
            begun = True
            continue
        flush()
        piece = vocab.surface[i]
        out.append((piece[1:] if not begun and vocab.blank_first[i] else piece).decode())
        begun = begun or bool(piece)
    flush()
    return "".join(out)


def encode_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (list of int, end id last) and decoded text of every whole text, one row per row of ``docs``.

    A null text is the empty text, whose only id is the end id. Repeated rows give repeated rows, an empty table none;
    other columns of ``docs`` are ignored. ``model_path`` is a file that every executor has. The vocabulary is read on
    the driver (its size is the model's) and sent to the tasks.
    """
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(Vocabulary(model_path))

    def run(batches):
        vocab = shared.value
        encoder = Encoder(vocab)
        for part in slices(batches):
            ids, counts = encoder.encode(part.column("text").to_pylist())
            offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
            decoded = decode_all(ids, counts, vocab)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), pa.array(decoded, pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")
