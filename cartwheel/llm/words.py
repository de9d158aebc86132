"""Words of a slice of documents as flat arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?")] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[[c for c in range(128) if chr(c).isalnum()]] = True


class Words:
    """All words ``[^\\x20\\x09-\\x0D]+`` of a slice: ``strings`` (in order) and ``counts`` per document.

    With ``stops`` a single stop at the end of a word, behind an ASCII letter or digit, is a word of its own.
    """

    def __init__(self, column: pa.Array | pa.ChunkedArray, stops: bool = False):
        values = [v.as_buffer() if v.is_valid else b"" for v in column.cast(pa.large_binary())]
        sizes = np.fromiter(map(len, values), np.int64, len(values))
        raw = np.frombuffer(b"".join(values), np.uint8)
        ends = np.cumsum(sizes)
        solid = ~_BLANK[raw]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        cuts = (ends - sizes)[(sizes > 0)]
        first[cuts] = solid[cuts]
        cuts = cuts[cuts > 0] - 1
        last[cuts] = solid[cuts]
        if stops and len(raw) > 1:
            own = last[1:] & _STOP[raw[1:]] & _PLAIN[raw[:-1]]
            own[ends[(ends > 0) & (ends < len(raw))] - 1] = False
            first[1:] |= own
        starts = np.flatnonzero(first)
        at = np.searchsorted(starts, ends)
        self.counts = np.diff(at, prepend=0)
        # Bytes of the words without the blanks between them; a word ends where the next one starts.
        kept = np.cumsum(solid)
        offsets = np.r_[kept[starts] - 1, kept[-1:]] if len(starts) else np.zeros(1, np.int64)
        self.strings = pa.StringArray.from_buffers(
            len(starts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw[solid])
        )

    def symbols(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, equal for equal words, and the distinct words by number."""
        coded = self.strings.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def joined(words: pa.Array, counts: np.ndarray) -> pa.Array:
    """One string per document: its words with one space between."""
    offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, words), " ")
