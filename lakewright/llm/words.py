"""Words of many texts at once, as arrays of 64-bit numbers.

A word is a run of characters other than the blank and the controls 9 to 13. All
functions take the Arrow column of one batch and work on its bytes, so no Python
object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at a time; bounds the memory of a batch with very long texts.
SEGMENT = 1 << 21
_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def column(batch, name: str) -> pa.Array:
    """A column of a batch or table as one array."""
    found = batch.column(batch.schema.get_field_index(name))
    if isinstance(found, pa.ChunkedArray):
        found = found.combine_chunks()
        if isinstance(found, pa.ChunkedArray):
            found = pa.concat_arrays(found.chunks) if found.num_chunks else pa.array([], found.type)
    return found


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts (null: empty) and where each text begins, with the end."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or at[-1] == at[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


class Hasher:
    """Hashes of byte runs. Make one per task: its tables of powers are kept between batches."""

    def __init__(self) -> None:
        self.powers = np.ones(1, U64)
        self.inverses = np.ones(1, U64)
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            many = np.full(n, _BASE, U64)
            many[0] = 1
            self.powers = np.multiply.accumulate(many)
            many[1:] = _INVERSE
            self.inverses = np.multiply.accumulate(many)

    def runs(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """One number for the bytes of each run; runs are in order and do not overlap."""
        out = np.empty(len(start), U64)
        i = 0
        while i < len(start):
            j = max(i + 1, int(np.searchsorted(end, start[i] + SEGMENT)))
            low, high = int(start[i]), int(end[j - 1])
            self._grow(high - low + 1)
            total = np.zeros(high - low + 1, U64)
            np.cumsum((data[low:high].astype(U64) + U64(1)) * self.powers[: high - low], out=total[1:])
            s, e = start[i:j] - low, end[i:j] - low
            out[i:j] = mix((total[e] - total[s]) * self.inverses[s] + (e - s).astype(U64))
            i = j
        return out

    def spans(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of every word, and the number of the first word of each text, with the end."""
        word = ~self.space[data]
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        edge = at[(at > 0) & (at < len(data))]  # two texts touch here
        begins[edge] = word[edge]
        ends[edge - 1] = word[edge - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        return start, end, np.searchsorted(start, at)

    def words(self, texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """A number for each word, and the number of the first word of each text, with the end."""
        data, at = text_bytes(texts)
        if lower:
            data = self.lower[data]
        start, end, first = self.spans(data, at)
        return self.runs(data, start, end), first


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """A number for each run of ``size`` words; those that cross texts are for the caller to leave out."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.zeros(n, U64)
    for k in range(size):
        out = out * U64(_BASE) + words[k : k + n]
    return mix(out + U64(size))


def slices(batches: Iterator[pa.RecordBatch], name: str, limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that the texts of one hold about ``limit`` bytes; one text is never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(column(batch, name)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < batch.num_rows:
            before = size[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(size, before + limit, "right")))
            yield batch.slice(i, j - i)
            i = j
