"""Best-two-fit packing of tokenised documents into sequences of one capacity."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import python_ready, slices, whole_text, written
from cartwheel.llm.words import Words

CAPACITY, END = 4096, 1
#: Pieces that one task packs at a time; documents beyond that are packed in several groups.
GROUP = 1 << 16
#: A sequence with a larger share of it free is opened again and packed with the open ones of other groups.
OPEN_SHARE = 64
ROUNDS = 12
#: Distinct words whose ids a Python worker remembers.
REMEMBERED = 600_000
PIECES = "row long, doc_id long, piece int, start long, length long, ids binary"
_loaded: dict[str, tuple] = {}


def _encoder(path: str, content: bytes):
    """The tokenizer and the ids of words seen by this worker, loaded once."""
    if path not in _loaded:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _loaded[path] = (Tokenizer.from_str(content.decode()), {})
    return _loaded[path]


def _ids_of(words: list[str], tokenizer, known: dict):
    """Flat ids of the given distinct words and how many each has."""
    new = [w for w in words if w not in known]
    encoded = {}
    for i in range(0, len(new), 4096):
        part = new[i : i + 4096]
        for word, found in zip(part, tokenizer.encode_batch_fast(part, add_special_tokens=False)):
            encoded[word] = np.array(found.ids, np.uint32).tobytes()
    if len(known) < REMEMBERED:
        known.update(encoded)
        each = [known[w] for w in words]
    else:
        each = [encoded[w] if w in encoded else known[w] for w in words]
    return np.frombuffer(b"".join(each), np.uint32), np.fromiter(map(len, each), np.int64, len(each)) >> 2


def _tokenise(path: str, content, capacity: int, end_id: int):
    def run(batches):
        tokenizer, known = _encoder(path, content.value)
        for batch in slices(batches):
            # Neither a pattern of the tokenizer nor its normal forms reach over a blank, nor over a stop behind an
            # ASCII letter or digit that ends a word, so that words can be encoded on their own, each kind once.
            words = Words(batch.column("text"), stops=True)
            symbols, kinds = words.symbols()
            flat, sizes = _ids_of(kinds.to_pylist(), tokenizer, known)
            first = np.cumsum(sizes) - sizes
            each = sizes[symbols]
            done = np.cumsum(each)
            token = flat[np.repeat(first[symbols] - (done - each), each) + np.arange(int(done[-1]) if len(done) else 0)]
            # The end id goes behind the tokens of each document.
            upto = np.r_[0, done][np.cumsum(words.counts)]
            ids = np.insert(token, upto, end_id).astype("<u4")
            stop = upto + np.arange(1, len(upto) + 1)
            begin = np.r_[0, stop[:-1]]
            n_pieces = -(-(stop - begin) // capacity)
            doc = np.repeat(np.arange(len(n_pieces)), n_pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = piece * capacity
            length = np.minimum(capacity, (stop - begin)[doc] - start)
            offsets = np.r_[0, np.cumsum(length)] * 4
            which = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(which),
                    batch.column("doc_id").take(which),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start.astype(np.int64)),
                    pa.array(length.astype(np.int64)),
                    pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), len(doc), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)]
                    ).cast(pa.binary()),
                ],
                names=[c.split()[0] for c in PIECES.split(", ")],
            )

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END) -> DataFrame:
    """Written pieces of all documents: row, doc_id, piece, start, length, ids (little-endian 32 bits), ids_crc32.

    ``row`` numbers the rows of ``docs``. A document is its ids and ``end_id``; only one of more than ``capacity`` ids
    is cut, each piece but the last being full. A null text is empty and gives the end id alone, as does a text without
    tokens; a null doc_id stays null; repeated rows are documents of their own; other columns are ignored. The file of
    the tokenizer is read on the driver and sent to the tasks.
    """
    spark = docs.sparkSession
    python_ready(spark)
    with open(tokenizer_path, "rb") as file:
        content = spark.sparkContext.broadcast(file.read())
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")
    )
    made = rows.mapInArrow(_tokenise(tokenizer_path, content, capacity, end_id), PIECES)
    return written(made.withColumn("ids_crc32", F.crc32("ids")), "pack-pieces", compression="zstd")


def best_two_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; lengths lie between 1 and ``capacity``.

    Bins are filled one after the other: the largest piece left, then always the largest that still fits. Where a gap
    stays and the bin holds several pieces, its smallest is put back if two unpacked pieces fit the gap and its place
    more tightly than it does; of all pairs the one that fills most is taken, then filling goes on.
    """
    order = np.argsort(lengths, kind="stable")
    count = np.bincount(lengths, minlength=capacity + 1)
    place = np.cumsum(count) - count
    taken = np.zeros_like(count)
    left = np.flatnonzero(count).tolist()  # lengths that are still there, ascending
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)

    def take(length):
        count[length] -= 1
        if not count[length]:
            del left[bisect_right(left, length) - 1]

    def put_back(length):
        if not count[length]:
            left.insert(bisect_right(left, length), length)
        count[length] += 1

    def fill(held, gap):
        while gap and left and left[0] <= gap:
            length = left[bisect_right(left, gap) - 1]
            again = min(int(count[length]), gap // length)
            for _ in range(again):
                take(length)
            held += [length] * again
            gap -= length * again
        return gap

    def best_pair(room, least):
        """Two unpacked lengths with the largest sum that is at most ``room`` and above ``least``."""
        free = count[: room + 1] > 0
        exact = np.flatnonzero(free & free[::-1])
        if len(exact):
            a = int(exact[0])
            if 2 * a != room or count[a] > 1:
                return a, room - a
        some = np.flatnonzero(free)
        if not len(some):
            return None
        at = np.searchsorted(some, room - some, side="right") - 1
        # A length with one piece can't be both.
        at = np.where((at >= 0) & (some[at] == some) & (count[some] == 1), at - 1, at)
        total = np.where(at >= 0, some + some[at], 0)
        top = int(np.argmax(total))
        return (int(some[top]), int(some[at[top]])) if total[top] > least else None

    number = 0
    while left:
        held = []
        gap = fill(held, capacity)
        if gap and len(held) > 1:
            smallest = held[-1]
            pair = best_pair(gap + smallest, smallest)
            if pair:
                put_back(held.pop())
                gap += smallest - sum(pair)
                for length in pair:
                    take(length)
                    held.append(length)
                fill(held, gap)
        at = 0
        for length in held:
            where = order[place[length] + taken[length]]
            taken[length] += 1
            bins[where], offsets[where] = number, at
            at += length
        number += 1
    return bins, offsets


PACKED = "row long, piece int, length long, sequence_id long, offset long, free long"


def _pack_group(capacity: int, turn: int):
    def run(key, table):
        lengths = table.column("length").to_numpy()
        bins, offsets = best_two_fit(lengths, capacity)
        free = capacity - np.bincount(bins, weights=lengths).astype(np.int64)
        first = (turn << 57) | (key[0].as_py() << 25)
        return pa.table(
            [table.column("row"), table.column("piece"), table.column("length"), pa.array(first + bins), pa.array(offsets),
             pa.array(free[bins])],
            names=[c.split()[0] for c in PACKED.split(", ")],
        )

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """row, piece, sequence_id and offset of every piece (row, piece, length), in few sequences of ``capacity``.

    Pieces are dealt by hash into groups of about ``group``, each packed by ``best_two_fit`` in a task. Sequences with
    over 1/64 of their capacity free are opened and their pieces are packed again with those of other groups, in ever
    fewer groups, as long as this saves groups. So the sequences are those of one packing up to what a last group
    leaves, and no task holds more than a group. An empty table gives no rows; repeated rows are pieces of their own.
    """
    left = pieces.select("row", "piece", "length")
    n = left.count()
    done = None
    for turn in range(ROUNDS):
        groups = max(1, -(-n // group))
        dealt = left.withColumn("_group", F.pmod(F.xxhash64("row", "piece", F.lit(turn)), F.lit(groups)))
        packed = written(dealt.groupBy("_group").applyInArrow(_pack_group(capacity, turn), PACKED), "packed")
        again = F.col("free") > capacity // OPEN_SHARE
        still = packed.where(again).count() if groups > 1 else 0
        last = groups == 1 or turn == ROUNDS - 1 or still == 0 or 2 * still > n
        final = (packed if last else packed.where(~again)).select("row", "piece", "sequence_id", "offset")
        done = final if done is None else done.union(final)
        if last:
            return done
        left, n = packed.where(again).select("row", "piece", "length"), still
    return done


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids, ids_crc32, sequence_id and offset of every piece of every document."""
    pieces = token_pieces(docs, tokenizer_path, capacity, end_id)
    return pieces.join(pack(pieces, capacity), ["row", "piece"]).drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids (little-endian 32 bits) of every packed sequence, its pieces by offset; one is bounded."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.unhex(F.array_join(F.transform(parts, lambda p: F.hex(p["ids"])), ""))
    return packed.groupBy("sequence_id").agg(whole.alias("ids"))
