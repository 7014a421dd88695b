"""Words of an Arrow text column as 64-bit hashes, computed over whole batches at once.

A word is a run of bytes other than the six ASCII blanks, with A-Z lower-cased. Its hash is a
polynomial over its bytes modulo 2**64, taken from prefix sums, and mixed with its length.
"""

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

# Bytes of text worked on at once; a longer text is worked on alone.
CHUNK = 1 << 19

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True

_powers = {}


def _power(base, n):
    """The powers of ``base`` from 0 to ``n`` modulo 2**64, kept for the next call."""
    known = _powers.get(base)
    if known is None or len(known) <= n:
        size = max(n + 1, CHUNK + 1)
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _powers[base] = known
    return known


def mix(x):
    """Spread 64-bit numbers evenly (in a new array)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column):
    """Bytes and offsets of an Arrow string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(column):
    """``(first, last, data, offsets)`` of runs of whole texts of about ``CHUNK`` bytes."""
    data, offsets = text_buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first]:offsets[last]], \
            offsets[first:last + 1] - offsets[first]
        first = last


def hashed_words(data, offsets):
    """Hash of every word, and per text the index of its first word (one more at the end)."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(n + 1, dtype=np.int64)
    word = ~_BLANK[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < len(data)]
    begins[inner] = word[inner]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    inner = inner[inner > 0]
    ends[inner - 1] = word[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_LOWER[data] * _power(_BASE, len(data))[:len(data)], out=prefix[1:])
    hashes = (prefix[end] - prefix[start]) * _power(_INVERSE, len(data))[start]
    hashes += (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(hashes), np.searchsorted(start, offsets)
