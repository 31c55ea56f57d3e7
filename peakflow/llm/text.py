"""Words and word windows of Arrow text columns as numpy arrays.

All operators that hash words inside tasks share this module. Texts are read as UTF-8 bytes; a null
text is an empty one. Everything works on slices of a few megabytes, so a task's memory does not
follow the size of its Arrow batches (a single longer text is one slice)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(_SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_FOLDED = np.where(_IS_SPACE, np.uint8(0x20), _LOWER)
_STEP = 2048


def _powers(factor: int, n: int) -> np.ndarray:
    table = np.full(max(1, n), factor % (1 << 64), np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


_INVERSE = pow(_BASE, -1, 1 << 64)
_LOW, _INVERSE_LOW = _powers(_BASE, _STEP), _powers(_INVERSE, _STEP)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: differences of one running polynomial sum."""
    if not len(starts):
        return np.empty(0, np.uint64)
    steps = len(data) // _STEP + 1
    high, inverse_high = (_powers(pow(x, _STEP, 1 << 64), steps) for x in (_BASE, _INVERSE))
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE_VALUES[data] * np.multiply.outer(high, _LOW).ravel()[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse_high[starts // _STEP] * _INVERSE_LOW[starts % _STEP])


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z as a-z."""
    return _LOWER[data]


def folded(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z as a-z and white space as the space."""
    return _FOLDED[data]


@dataclass
class Words:
    """Words of a slice of texts. Text d has the words first[d] to first[d + 1] - 1."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows in them."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    whole = column.buffers()[2]
    data = np.frombuffer(whole, np.uint8) if whole is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def words_of(column: pa.Array, lower: bool = False) -> Words:
    """Runs of bytes other than space and tab to carriage return; `lower` folds A-Z only."""
    data, offsets = bytes_of(column)
    if lower:
        data = _LOWER[data]
    inside = ~_IS_SPACE[data]
    before, after = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    before[1:len(data)] = inside[:-1]
    after[:len(data) - 1 if len(data) else 0] = inside[1:]
    before[offsets[:-1]] = False
    after[offsets[1:][np.diff(offsets) > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before[:len(data)])
    ends = np.flatnonzero(inside & ~after[:len(data)]) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def ragged(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places begins[0], begins[0] + 1, ... of all stretches, one stretch after the other."""
    upto = np.cumsum(sizes)
    return np.repeat(begins - (upto - sizes), sizes) + np.arange(upto[-1] if len(upto) else 0)


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each different byte span, and for every span which of these it equals.

    Hashes only propose; every span is compared byte by byte with the one that stands for it, and should two
    different ones share a hash, all are told apart by their bytes instead."""
    _, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    size, like = ends - starts, first[inverse]
    same = np.array_equal(size, size[like])
    for a in range(0, len(starts) if same else 0, 1 << 17):
        part = slice(a, a + (1 << 17))
        same = same and np.array_equal(data[ragged(starts[part], size[part])], data[ragged(starts[like[part]], size[part])])
    if not same:
        raw, known = data.tobytes(), {}
        inverse = np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)
        first = np.unique(inverse, return_index=True)[1]
    return first, inverse


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` consecutive values that start at each place (before the last size - 1)."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    factor = 1
    for k in range(size):
        out += words[k:k + n] * np.uint64(factor)
        factor = factor * 0xD1342543DE82EF95 % (1 << 64)
    return mix(out)


def complete(first: np.ndarray, size: int) -> np.ndarray:
    """Which of those windows lie within one text."""
    n = max(0, int(first[-1]) - size + 1)
    end = np.repeat(first[1:], np.diff(first))[:n]
    return np.arange(n) + size <= end


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of at most `limit` bytes of text (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(bytes_of(batch.column(text))[1])
        at, total = 0, np.cumsum(sizes)
        while at < batch.num_rows:
            done = total[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(total, done + limit, side="right")))
            yield batch.slice(at, upto - at)
            at = upto


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as the long values Spark knows."""
    return x.view(np.int64)
