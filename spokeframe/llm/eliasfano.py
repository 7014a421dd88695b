"""Levels of a trie in compact bytes: rising integers by Elias and Fano, searched where they lie.

``Sequence`` is a rising sequence: the high bits of its numbers are in unary in a bit vector, the low
bits packed side by side. A directory counts the ones before each 64-bit word of the bit vector, so a
number, or the place of one, is found without unpacking. ``Level`` has the successors of contexts:
monotone pointers to each context's first successor, and the successors themselves, made rising over
the whole level by adding what the context before ends with. All look-ups take arrays.
"""

import numpy as np

# Numbers packed at once; a multiple of eight, so that every block ends with a byte.
_BLOCK = 1 << 13

# Masks that repeat over a 64-bit word.
_U = tuple(np.uint64(x) for x in range(9))
_ODD, _PAIRS, _NIBBLES, _ONES, _TOPS, _BYTE = (np.uint64(x) for x in (
    0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F, 0x0101010101010101,
    0x8080808080808080, 0xFF))

# Place of the n-th one of a byte, at 8 * byte + n.
_IN_BYTE = np.array([([i for i in range(8) if byte >> i & 1] + [0] * 8)[n]
                     for byte in range(256) for n in range(8)], dtype=np.int64)


def pack_bits(values, width):
    """``values`` of ``width`` bits each, side by side, as bytes with eight spare ones."""
    packed, places = [], np.arange(width, dtype=np.uint64)
    for at in range(0, len(values) if width else 0, _BLOCK):
        bits = (values[at:at + _BLOCK].astype(np.uint64)[:, None] >> places) & np.uint64(1)
        packed.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(packed) + bytes(8)


def take_bits(data, width, at):
    """The packed values at the positions ``at``; widths up to 56 bits."""
    if not width:
        return np.zeros(len(at), dtype=np.uint64)
    begin = at.astype(np.int64) * width
    # The 64-bit word that begins with any byte.
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    word = words[begin >> 3]
    return (word >> (begin & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)


def join(parts):
    """Byte strings as one, each at a multiple of eight bytes, after a table of their lengths."""
    head = np.array([len(parts), *map(len, parts)], dtype=np.int64).tobytes()
    return head + b"".join(part + bytes(-len(part) % 8) for part in parts)


def split(data):
    """The parts of ``join`` as views."""
    n = int(data[:8].view(np.int64)[0])
    lengths = data[8:8 + 8 * n].view(np.int64).tolist()
    at, out = 8 + 8 * n, []
    for length in lengths:
        out.append(data[at:at + length])
        at += length + -length % 8
    return out


def _nth_one(words, n):
    """Place of the n-th one (from 0) in each 64-bit word: its byte by sums over all bytes at once,
    then its place in the byte by a table."""
    n = n.astype(np.uint64)
    sums = words - ((words >> _U[1]) & _ODD)
    sums = (sums & _PAIRS) + ((sums >> _U[2]) & _PAIRS)
    sums = ((sums + (sums >> _U[4])) & _NIBBLES) * _ONES
    # Bytes up to which there are not more than n ones.
    place = np.bitwise_count((((n * _ONES) | _TOPS) - sums) & _TOPS).astype(np.uint64) << _U[3]
    n -= ((sums << _U[8]) >> place) & _BYTE
    byte = (words >> place) & _BYTE
    return place.astype(np.int64) + _IN_BYTE[(byte << _U[3]) | n]


class Sequence:
    """Rising integers, as written by ``encode``; ``data`` is an array of bytes, mapped or not."""

    def __init__(self, data):
        head, high, before, self.low = split(data)
        self.n, self.width, self.buckets = head.view(np.int64).tolist()
        self.high, self.ones = high.view(np.uint64), before.view(np.uint32)
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones

    @staticmethod
    def encode(values, universe):
        """``values`` rise and lie below ``universe``."""
        n = len(values)
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        buckets = (universe >> width) + 1
        # Bucket after bucket: a one for each of its numbers, then a zero.
        unary = np.zeros(-(-(n + buckets) // 64) * 64, dtype=np.uint8)
        unary[(values >> width).astype(np.int64) + np.arange(n)] = 1
        high = np.packbits(unary, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(high).astype(np.int64)
        low = pack_bits(values & ((1 << width) - 1), width)
        return join([np.array([n, width, buckets], dtype=np.int64).tobytes(), high.tobytes(),
                     (np.cumsum(counts) - counts).astype(np.uint32).tobytes(), low])

    def _lows(self, at):
        return take_bits(self.low, self.width, at).astype(np.int64)

    def get(self, at):
        """The numbers at the places ``at``."""
        word = np.searchsorted(self.ones, at, "right") - 1
        one = word * 64 + _nth_one(self.high[word], at - self.ones[word])
        return ((one - at) << self.width) | self._lows(at)

    def _end(self, bucket):
        """How many numbers lie in the buckets up to each one."""
        word = np.searchsorted(self.zeros, bucket, "right") - 1
        zero = word * 64 + _nth_one(~self.high[word], bucket - self.zeros[word])
        return zero - bucket

    def find(self, numbers):
        """``(present, place)`` of each number; quickest where they rise."""
        bucket = numbers >> self.width
        inside = (bucket >= 0) & (bucket < self.buckets)
        if not self.n or not len(numbers):
            return np.zeros(len(numbers), dtype=bool), np.zeros(len(numbers), dtype=np.int64)
        bucket = np.where(inside, bucket, 0)
        last = self._end(bucket)
        begin, end = np.where(bucket > 0, self._end(np.maximum(bucket - 1, 0)), 0), last.copy()
        wanted = numbers & ((1 << self.width) - 1)
        while True:
            searched = np.flatnonzero(begin < end)
            if not len(searched):
                break
            middle = (begin[searched] + end[searched]) >> 1
            below = self._lows(middle) < wanted[searched]
            begin[searched[below]] = middle[below] + 1
            end[searched[~below]] = middle[~below]
        present = inside & (begin < last)
        place = np.where(present, begin, 0)
        return present & (self._lows(place) == wanted), place


class Level:
    """Successors of contexts with one quantised value each, as written by ``encode``."""

    def __init__(self, data, bits):
        pointers, grams, self.values = split(data)
        self.pointers, self.grams, self.bits = Sequence(pointers), Sequence(grams), bits

    @staticmethod
    def encode(contexts, parent, successor, values, bits):
        """Rows rise by ``parent``, below ``contexts``, and by ``successor`` within a parent."""
        sizes = np.bincount(parent, minlength=contexts)
        pointers = np.concatenate([[0], np.cumsum(sizes)])
        ends = pointers[1:][sizes > 0] - 1
        spans = np.zeros(contexts, dtype=np.int64)
        spans[sizes > 0] = successor[ends] + 1
        base = np.cumsum(spans) - spans
        return join([Sequence.encode(pointers, len(parent) + 1),
                     Sequence.encode(base[parent] + successor, int(spans.sum()) + 1),
                     pack_bits(values, bits)])

    def find(self, context, successor):
        """``(present, place)`` of each successor, searched relative to its context's own begin."""
        new = np.ones(len(context), dtype=bool)
        new[1:] = context[1:] != context[:-1]
        names, where = context[new], np.cumsum(new) - 1
        begin, end = self.pointers.get(names), self.pointers.get(names + 1)
        base = np.zeros(len(names), dtype=np.int64)
        later = np.flatnonzero(begin > 0)
        base[later] = self.grams.get(begin[later] - 1) + 1
        present, place = self.grams.find(base[where] + successor)
        return present & (place >= begin[where]) & (place < end[where]), place

    def value(self, place):
        return take_bits(self.values, self.bits, place)
