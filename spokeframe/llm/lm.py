"""Language-model scores of documents from an n-gram trie in Elias-Fano levels.

Words are lower-cased (A-Z) and hashed to 64 bits; a text is its words and an end token. All counts
cover all training rows, every word has contexts of its own, and the trie grows with the corpus.

* Vocabulary. Every training word with its count, summed in the tasks and then over the table.
  *Resident* words, each at least 1 in ``RESIDENT`` of all training tokens (so there are never more
  than that, 64 MB), go to the tasks; rarer words meet their counts by a join on the word.
* Trie. ``p(w | u v)`` interpolates orders three, two and one with an absolute discount. The trie is
  cut into shards by the middle word: the shard of ``v`` has the words after ``v``, the words ``u``
  before it, and under each context ``u v`` the words that follow. These are three Elias-Fano levels
  with monotone pointers and quantised discounted shares, searched in a memory-mapped file of the task
  that built them. A word with more than ``WIDE`` tokens is spread over shards by ``u``; the words
  after it are then summed beforehand and given to each of them. So a task holds some millions of runs
  at most, or the distinct words after one word where these are more.
* Scoring. Each task sends a chunk's runs of three words to their shards as packed columns, once for
  counts and scores alike. A shard's task reads its chunks one after the other, first to build the
  shard, then to look up their runs; it holds one shard, and keeps more than ``KEPT`` bytes of chunks
  in a file. So a run that a third of all documents have costs memory in no task.
* What a shard answers is linear in the last order: ``p = a + b * p1(w)``. Resident words are done
  with there; rarer ones take ``a`` and ``b`` to the join with their counts.
* What discounts save goes to the next lower order, and from the last one to the unknown word.

So the model's probabilities of all known words and the unknown one after any context add up to one,
but for the quantisation (``BITS`` bits of a logarithm, about 0.3 % of a share).

Defined results: a null text is empty and has the end token alone; a text's first token follows two
ends. Rows without id are training rows. Without training rows every word is unknown. Repeated rows
count as often as they stand there. Very long texts are worked on in several chunks. An empty table
gives no rows; columns other than the id and the text are not read.
"""

import mmap
import struct
import tempfile

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F

from spokeframe.llm.columns import only
from spokeframe.llm.eliasfano import Level, Sequence, join, pack_bits, split, take_bits
from spokeframe.llm.wordhash import chunks, hashed_words, mix
from spokeframe.llm.workers import tidy
from spokeframe.session import through_table

RESIDENT = 1 << 22

# Training tokens of a shard on average, and of a word before it is spread over several shards.
SHARD, WIDE = 1 << 19, 1 << 21

# What orders three and two take off each count.
DISCOUNT = 0.75

# Quantised log10 shares: this many bits from the least to 0.
BITS, LEAST = 12, -12.0

# Distinct words that a task sums before it passes them on, and tokens that it sends as one chunk.
HELD, CHUNK_BITS = 1_000_000, 20
CHUNK_TOKENS = 1 << CHUNK_BITS

# Runs looked up at once, documents whose sums a task holds, and bytes of a shard's chunks in memory.
LOOKED_UP, DOCUMENTS, KEPT = 1 << 17, 1 << 20, 1 << 26

# The hash that stands for the end of a text.
END = np.uint64(0)

# Codes of words without a resident's number have this bit.
RARE = np.uint64(1 << 63)

# Stands for such a code among codes of 32 bits.
_RARER = np.uint64((1 << 32) - 1)


def token_stream(column):
    """``(first, tokens, bounds)``: hashes of texts in a row, each closed by the end token."""
    for first, last, data, offsets in chunks(column):
        words, begins = hashed_words(data, offsets)
        words = np.where(words == END, np.uint64(1), words)
        yield first, np.insert(words, begins[1:], END), begins + np.arange(len(begins))


class Sums:
    """Counts of numbers, merged as they come."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, numbers):
        self.parts.append(np.unique(numbers, return_counts=True))
        self.size += len(self.parts[-1][0])
        if self.size > 2 * HELD:
            merged = self.take()
            self.parts, self.size = [merged], len(merged[0])

    def take(self):
        if not self.parts:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        numbers, counts = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.size = [], 0
        values, where = np.unique(numbers, return_inverse=True)
        return values, np.bincount(where, weights=counts, minlength=len(values)).astype(np.int64)

    def batches(self, names, final):
        if final or self.size > HELD:
            values, counts = self.take()
            for at in range(0, len(values), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[at:at + 100_000].view(np.int64)),
                     pa.array(counts[at:at + 100_000])], names=names)


def word_counts(docs):
    """``word, count`` over the rows' texts."""
    def run(batches):
        sums = Sums()
        for batch in batches:
            for _, tokens, _ in token_stream(batch.column("text")):
                sums.add(tokens)
            yield from sums.batches(["word", "count"], False)
        yield from sums.batches(["word", "count"], True)

    counted = docs.select("text").mapInArrow(tidy(run), "word bigint, count bigint")
    return counted.groupBy("word").agg(F.sum("count").alias("count"))


class Residents:
    """Numbers and counts of the resident words; ``code`` gives any word a number of its own."""

    def __init__(self, words, counts):
        words = np.array(words, dtype=np.int64).view(np.uint64)
        order = np.argsort(words)
        self.words, self.counts = words[order], np.array(counts, dtype=np.int64)[order]

    def code(self, tokens):
        if not len(self.words):
            return tokens | RARE
        at = np.minimum(np.searchsorted(self.words, tokens), len(self.words) - 1)
        return np.where(self.words[at] == tokens, at.astype(np.uint64), tokens | RARE)

    def count(self, codes):
        """Count of each resident code, 0 for the others."""
        if not len(self.words):
            return np.zeros(len(codes), dtype=np.int64)
        resident = codes < RARE
        return np.where(resident, self.counts[np.where(resident, codes, np.uint64(0))], 0)


class Spread:
    """The shard of a run: by its middle word, and by the word before where the middle is frequent."""

    def __init__(self, shards, words, ways):
        order = np.argsort(np.array(words, dtype=np.uint64))
        self.shards = shards
        self.words = np.array(words, dtype=np.uint64)[order]
        self.ways = np.array(ways, dtype=np.int64)[order]

    def is_wide(self, codes):
        return np.isin(codes, self.words)

    def first(self, codes):
        return (mix(codes) % np.uint64(self.shards)).astype(np.int64)

    def shard(self, middle, before):
        shard = self.first(middle)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, middle), len(self.words) - 1)
            wide = np.flatnonzero(self.words[at] == middle)
            way = mix(before[wide] ^ np.uint64(0x5851F42D4C957F2D)) % self.ways[at[wide]].astype(
                np.uint64)
            shard[wide] = (shard[wide] + way.astype(np.int64)) % self.shards
        return shard


def packed(*arrays):
    """Arrays as one compressed byte string, byte by byte of their numbers."""
    head = struct.pack("<B", len(arrays)) + b"".join(
        struct.pack("<2sI", a.dtype.str[1:].encode(), len(a)) for a in arrays)
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
              for a in arrays)
    return zstandard.compress(head + b"".join(planes), 1)


def unpacked(data):
    data = zstandard.decompress(data)
    at, out = 1 + 6 * data[0], []
    for i in range(data[0]):
        kind, n = struct.unpack_from("<2sI", data, 1 + 6 * i)
        kind = np.dtype("<" + kind.decode())
        planes = np.frombuffer(data, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def in_parts(codes):
    """Codes as 32 bits each, and the rarer words' ones in full."""
    rare = codes >= RARE
    return np.where(rare, _RARER, codes).astype(np.uint32), codes[rare]


def whole(low, rare):
    codes = low.astype(np.uint64)
    codes[low == _RARER] = rare
    return codes


def new_runs(*columns):
    """Where a row of sorted columns differs from the one before."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new):
        new[1:] = False
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
    return new


def summed(counts, at):
    return np.add.reduceat(counts, at) if len(at) else counts[:0]


def contexts_of(codes, bounds, end):
    """The two tokens before each token; a text's first token follows two ends."""
    before, second = np.empty_like(codes), np.empty_like(codes)
    before[1:], second[2:] = codes[:-1], codes[:-2]
    firsts = bounds[:-1]
    before[firsts] = second[firsts] = end
    longer = firsts[np.diff(bounds) > 1] + 1
    second[longer] = end
    return before, second


def frequent_pairs(docs, known, wide):
    """``word, next, count`` of pairs whose first word is one of the codes ``wide``."""
    def run(batches):
        end, words, held, size = known.value.code(np.array([END]))[0], wide.value, [], 0

        def out():
            first, second, n = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((second, first))
            first, second = first[order], second[order]
            at = np.flatnonzero(new_runs(first, second))
            n = summed(n[order], at)
            for lo in range(0, len(at), 100_000):
                rows = at[lo:lo + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first[rows].view(np.int64)), pa.array(second[rows].view(np.int64)),
                     pa.array(n[lo:lo + 100_000])], names=["word", "next", "count"])

        for batch in batches:
            for _, tokens, bounds in token_stream(batch.column("text")):
                codes = known.value.code(tokens)
                before = contexts_of(codes, bounds, end)[0]
                mine = np.isin(before, words)
                held.append((before[mine], codes[mine], np.ones(mine.sum(), dtype=np.int64)))
                size += len(held[-1][0])
                if size > HELD:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()

    counted = docs.select("text").mapInArrow(
        tidy(run), "word bigint, next bigint, count bigint")
    return counted.groupBy("word", "next").agg(F.sum("count").alias("count"))


_SENT = "shard int, kind int, data binary"
_SENT_NAMES = ["shard", "kind", "data"]
PAIRS, RUNS, HEADS = 0, 1, 2


def sent(shards, kind, data):
    return pa.RecordBatch.from_arrays(
        [pa.array(shards, pa.int32()), pa.array([kind] * len(shards), pa.int32()),
         pa.array(data, pa.binary())], names=_SENT_NAMES)


def send_pairs(spread):
    """Pairs of frequent words, to each shard that such a word is spread over."""
    def run(batches):
        shards, data = [], []
        for batch in batches:
            word, after = (np.asarray(batch.column(c)).view(np.uint64) for c in ("word", "next"))
            count = np.asarray(batch.column("count"))
            for at, code in enumerate(spread.value.words):
                mine = np.flatnonzero(word == code)
                if len(mine):
                    block = packed(word[mine], after[mine], count[mine])
                    first = spread.value.first(word[mine[:1]])[0]
                    for way in range(spread.value.ways[at]):
                        shards.append(int((first + way) % spread.value.shards))
                        data.append(block)
                        if len(data) == 100:
                            yield sent(shards, PAIRS, data)
                            shards, data = [], []
        if data:
            yield sent(shards, PAIRS, data)

    return run


def send_runs(known, spread, base_of):
    """Every text's runs of three words, packed per chunk of texts and shard, and a chunk's heads:
    per document its id, tokens and what resident words give to the base."""
    def run(batches):
        residents, to = known.value, spread.value
        end = residents.code(np.array([END]))[0]
        uid = TaskContext.get().partitionId() << 40
        held, size, docs = [], 0, 0

        def out(begin):
            w, v, u, doc, learned = (np.concatenate(x) for x in zip(*held))
            # One number sorts by shard and nearly by words, and ends with the place.
            shard = to.shard(v, u)
            free = 63 - CHUNK_BITS - int(to.shards).bit_length()
            of_v, of_u = free - free * 2 // 5, free * 2 // 5
            key = shard.astype(np.uint64) << np.uint64(of_v)
            key = (key | (mix(v) >> np.uint64(64 - of_v))) << np.uint64(of_u)
            key = (key | (mix(u) >> np.uint64(64 - of_u))) << np.uint64(CHUNK_BITS)
            key |= np.arange(len(w), dtype=np.uint64)
            key.sort()
            order = (key & np.uint64((1 << CHUNK_BITS) - 1)).astype(np.int64)
            v, u, w, doc = v[order], u[order], w[order], doc[order]
            at = np.flatnonzero(new_runs(v, u, w, doc))
            times = np.diff(np.append(at, len(order))).astype(np.uint32)
            if len(at) < len(order):
                v, u, w, doc, order = v[at], u[at], w[at], doc[at], order[at]
            shard, learned = shard[order], learned[order]
            cuts = np.append(np.flatnonzero(new_runs(shard)), len(shard))
            own = np.array([begin], dtype=np.int64)
            shards, data = [], []
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                shards.append(int(shard[lo]))
                data.append(packed(
                    own, *in_parts(v[lo:hi]), *in_parts(u[lo:hi]), *in_parts(w[lo:hi]),
                    doc[lo:hi], times[lo:hi], learned[lo:hi]))
                if len(data) == 200:
                    yield sent(shards, RUNS, data)
                    shards, data = [], []
            if data:
                yield sent(shards, RUNS, data)

        for batch in batches:
            ids = batch.column("doc_id")
            trains = np.asarray(batch.column("learned").cast(pa.uint8()))
            for first, tokens, bounds in token_stream(batch.column("text")):
                codes = residents.code(tokens)
                v, u = contexts_of(codes, bounds, end)
                n, lengths = len(bounds) - 1, np.diff(bounds)
                counts = residents.count(codes)
                mine = ids.slice(first, n)
                base = np.where(counts > 0, base_of(counts), 0.0)
                yield sent([(uid + docs) % to.shards], HEADS, [packed(
                    np.arange(uid + docs, uid + docs + n),
                    np.asarray(mine.fill_null(0)), np.asarray(mine.is_valid().cast(pa.uint8())),
                    lengths, summed((counts > 0).astype(np.int64), bounds[:-1]),
                    summed(base, bounds[:-1]))])
                doc = np.repeat(np.arange(docs, docs + n, dtype=np.uint32), lengths)
                learned = np.repeat(trains[first:first + n], lengths)
                for lo in range(0, len(codes), CHUNK_TOKENS):
                    part = slice(lo, lo + CHUNK_TOKENS)
                    if size + len(codes[part]) > CHUNK_TOKENS and size:
                        yield from out(uid)
                        held, size = [], 0
                    held.append((codes[part], v[part], u[part], doc[part], learned[part]))
                    size += len(codes[part])
                docs += n
                if docs > DOCUMENTS or size == CHUNK_TOKENS:
                    yield from out(uid)
                    held, size, uid, docs = [], 0, uid + docs, 0
        if held:
            yield from out(uid)

    return run


def quantise(shares):
    steps = (1 << BITS) - 1
    with np.errstate(divide="ignore"):
        return np.clip(np.round(np.log10(shares) / LEAST * steps), 0, steps).astype(np.uint64)


_SHARES = 10.0 ** (np.arange(1 << BITS) * (LEAST / ((1 << BITS) - 1)))


class Numbers:
    """Places of codes among a shard's sorted ones: residents by a table, rarer ones by a search."""

    def __init__(self, words):
        residents = int(np.searchsorted(words, RARE))
        self.rare, self.before = words[residents:], residents
        self.table = np.full(int(words[residents - 1]) + 2 if residents else 1, -1, dtype=np.int32)
        self.table[words[:residents].astype(np.int64)] = np.arange(residents, dtype=np.int32)

    def of(self, codes):
        """The place of each code, -1 for others."""
        # The table's last entry is free and serves all codes beyond it.
        out = self.table[np.minimum(codes, np.uint64(len(self.table) - 1)).astype(np.int64)].astype(
            np.int64)
        if len(self.rare):
            rare = np.flatnonzero(codes >= RARE)
            at = np.minimum(np.searchsorted(self.rare, codes[rare]), len(self.rare) - 1)
            out[rare] = np.where(self.rare[at] == codes[rare], at + self.before, -1)
        return out


def all_words(*columns):
    """The distinct codes of the columns, rising."""
    rare = np.sort(np.concatenate([x[x >= RARE] for x in columns]))
    rare = rare[new_runs(rare)]
    columns = [x[x < RARE].astype(np.int64) for x in columns]
    seen = np.zeros(max((int(x.max()) + 1 for x in columns if len(x)), default=0), dtype=bool)
    for column in columns:
        seen[column] = True
    return np.concatenate([np.flatnonzero(seen).astype(np.uint64), rare])


def in_order(size, v, u, w):
    """Order of runs of words' places below ``size``, by one number where it can hold all three."""
    if size < 1 << 21:
        return np.argsort((v * size + u) * size + w)
    return np.lexsort((w, u, v))


class Shard:
    """A shard of the trie: words, middle words, pairs after them, contexts, runs."""

    def __init__(self, data):
        words, middles, spare, after, contexts, runs = split(np.frombuffer(data, dtype=np.uint8))
        self.words, self.middles, self.spare = words.view(np.uint64), Sequence(middles), spare
        self.numbers = Numbers(self.words)
        self.after, self.contexts, self.runs = (Level(x, BITS) for x in (after, contexts, runs))

    @staticmethod
    def encode(v, u, w, n, pairs, wide):
        """From sorted distinct runs with counts, and the ``pairs`` of words for which ``wide``."""
        own = ~wide(v)
        pair_v, pair_w, pair_n = (np.concatenate([x[own], y]) for x, y in zip((v, w, n), pairs))
        order = np.lexsort((pair_w, pair_v))
        pair_v, pair_w, pair_n = pair_v[order], pair_w[order], pair_n[order]
        at = np.flatnonzero(new_runs(pair_v, pair_w))
        pair_v, pair_w, pair_n = pair_v[at], pair_w[at], summed(pair_n, at)
        words = all_words(pair_v, pair_w, u, w)
        size, numbers = len(words), Numbers(words)

        def shares(parent, counts, parents):
            """Discounted share of each row, and what each parent has left."""
            total = np.bincount(parent, weights=counts, minlength=parents)
            left = DISCOUNT * np.bincount(parent, minlength=parents) / total
            return quantise((counts - DISCOUNT) / total[parent]), quantise(left)

        new = new_runs(pair_v)
        middles, middle = numbers.of(pair_v[new]), np.cumsum(new) - 1
        after, spare = shares(middle, pair_n, len(middles))
        new = new_runs(v, u)
        context_v = np.searchsorted(pair_v[new_runs(pair_v)], v[new])
        context, contexts = np.cumsum(new) - 1, int(new.sum())
        after_two, spare_two = shares(context, n, contexts)
        return join([
            words.tobytes(), Sequence.encode(middles, size + 1), pack_bits(spare, BITS),
            Level.encode(len(middles), middle, numbers.of(pair_w), after, BITS),
            Level.encode(len(middles), context_v, numbers.of(u[new]), spare_two, BITS),
            Level.encode(contexts, context, numbers.of(w), after_two, BITS)])


    def look_up(self, v, u, w):
        """``(a, b)`` of each run: its probability is ``a + b * p1(w)``."""
        a, b = np.zeros(len(v)), np.ones(len(v))
        if not len(self.words):
            return a, b
        v, u, w = (self.numbers.of(x) for x in (v, u, w))
        # In the trie's order, so that look-ups go through it from begin to end.
        order = in_order(len(self.words) + 1, v + 1, u + 1, w + 1)
        v, u, w = v[order], u[order], w[order]
        new = new_runs(v)
        names, where = v[new], np.cumsum(new) - 1
        present, place = self.middles.find(names)
        left = np.where(present, _SHARES[take_bits(self.spare, BITS, place)], 1.0)
        own_b, middle = left[where], np.where(present, place, -1)[where]
        own_a = np.zeros(len(v))
        rows = np.flatnonzero((middle >= 0) & (w >= 0))
        present, place = self.after.find(middle[rows], w[rows])
        own_a[rows[present]] = _SHARES[self.after.value(place[present])]
        # Contexts of two words, each looked up once.
        rows = np.flatnonzero((middle >= 0) & (u >= 0))
        new = new_runs(v[rows], u[rows])
        names, where = rows[new], np.cumsum(new) - 1
        present, place = self.contexts.find(middle[names], u[names])
        left = np.where(present, _SHARES[self.contexts.value(place)], 1.0)[where]
        own_a[rows] *= left
        own_b[rows] *= left
        context = np.where(present, place, -1)[where]
        found = (context >= 0) & (w[rows] >= 0)
        rows, context = rows[found], context[found]
        present, place = self.runs.find(context, w[rows])
        own_a[rows[present]] += _SHARES[self.runs.value(place[present])]
        a[order], b[order] = own_a, own_b
        return a, b


def mapped(data):
    """The bytes in a file that is mapped and already unlinked."""
    with tempfile.TemporaryFile() as file:
        file.write(data)
        file.flush()
        return mmap.mmap(file.fileno(), len(data), access=mmap.ACCESS_READ)


def unpacked_runs(data):
    begin, v, rare_v, u, rare_u, w, rare_w, doc, times, learned = unpacked(data)
    return begin, whole(v, rare_v), whole(u, rare_u), whole(w, rare_w), doc, times, learned


class Builder:
    """Counts of a shard's runs, merged as chunks come; the chunks are kept for the look-up."""

    def __init__(self):
        self.pairs, self.held, self.size = [], [], 0
        self.chunks = tempfile.SpooledTemporaryFile(max_size=KEPT)

    def add(self, kind, data):
        if kind == PAIRS:
            self.pairs.append(unpacked(data))
            return
        self.chunks.write(struct.pack("<q", len(data)) + data)
        _, v, u, w, _, times, learned = unpacked_runs(data)
        mine = learned > 0
        self.held.append((v[mine], u[mine], w[mine], times[mine].astype(np.int64)))
        self.size += len(v)
        if self.size > 2 * HELD:
            self.merge()

    def merge(self):
        none = np.zeros(0, dtype=np.uint64)
        v, u, w, n = (np.concatenate(x) for x in zip(
            (none, none, none, none.astype(np.int64)), *self.held))
        words = all_words(v, u, w)
        numbers = Numbers(words)
        order = in_order(len(words), *(numbers.of(x) for x in (v, u, w)))
        v, u, w = v[order], u[order], w[order]
        at = np.flatnonzero(new_runs(v, u, w))
        self.held, self.size = [(v[at], u[at], w[at], summed(n[order], at))], len(at) // 2
        return self.held[0]

    def shard(self, wide):
        none = np.zeros(0, dtype=np.uint64)
        pairs = [np.concatenate(x) for x in zip(
            (none, none, none.astype(np.int64)), *self.pairs)]
        data = Shard.encode(*self.merge(), pairs, wide)
        self.held, self.pairs = [], []
        return Shard(mapped(data))

    def batches(self):
        """The chunks' columns, some chunks at a time, with documents' numbers in full."""
        self.chunks.seek(0)
        parts, size = [], 0
        while head := self.chunks.read(8):
            begin, v, u, w, doc, times, _ = unpacked_runs(
                self.chunks.read(*struct.unpack("<q", head)))
            parts.append((v, u, w, begin[0] + doc.astype(np.int64), times.astype(np.int64)))
            size += len(v)
            if size > LOOKED_UP:
                yield [np.concatenate(x) for x in zip(*parts)]
                parts, size = [], 0
        if parts:
            yield [np.concatenate(x) for x in zip(*parts)]


_PARTS = "uid bigint, doc_id bigint, word bigint, n bigint, tokens bigint, known bigint, " \
         "base double, score double, a double, b double"
_PART_NAMES = [field.split()[0] for field in _PARTS.split(", ")]
_PART_TYPES = [pa.float64() if "double" in field else pa.int64() for field in _PARTS.split(", ")]


def part(size, **columns):
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[name], kind, mask=columns.get(name + "_null")) if name in columns
         else pa.nulls(size, kind) for name, kind in zip(_PART_NAMES, _PART_TYPES)], names=_PART_NAMES)


def score_shards(known, spread, first_order):
    """Reader of what the shards were sent, shard by shard: per document its head, what resident
    words score, and a row per rarer word and its ``a, b``."""
    def run(batches):
        residents, wide = known.value, spread.value.is_wide
        sums = {}

        def scored(builder):
            shard = builder.shard(wide)
            for v, u, w, uid, n in builder.batches():
                a, b = shard.look_up(v, u, w)
                counts = residents.count(w)
                mine = counts > 0
                own = n[mine] * np.log10(a[mine] + b[mine] * first_order(counts[mine]))
                uids, where = np.unique(uid[mine], return_inverse=True)
                for doc, value in zip(uids.tolist(), np.bincount(where, weights=own).tolist()):
                    sums[doc] = sums.get(doc, 0.0) + value
                rare = np.flatnonzero(~mine)
                for lo in range(0, len(rare), 50_000):
                    rows = rare[lo:lo + 50_000]
                    yield part(len(rows), uid=uid[rows], word=(w[rows] ^ RARE).view(np.int64),
                               n=n[rows], a=a[rows], b=b[rows])
                if len(sums) > DOCUMENTS:
                    yield from totals()

        def totals():
            uids, values = np.array(list(sums), dtype=np.int64), np.array(list(sums.values()))
            sums.clear()
            for lo in range(0, len(uids), 50_000):
                # These rows have a word that spreads them over the join's tasks.
                mine = uids[lo:lo + 50_000]
                yield part(len(mine), uid=mine, word=mine, score=values[lo:lo + 50_000])

        current, builder = None, None
        for batch in batches:
            for number, kind, data in zip(*(batch.column(c).to_pylist() for c in _SENT_NAMES)):
                if kind == HEADS:
                    uid, doc_id, valid, tokens, resident, base = unpacked(data)
                    yield part(len(uid), uid=uid, doc_id=doc_id, doc_id_null=valid == 0, word=uid,
                               tokens=tokens, known=resident, base=base)
                    continue
                if number != current:
                    if builder:
                        yield from scored(builder)
                    current, builder = number, Builder()
                builder.add(kind, data)
        if builder:
            yield from scored(builder)
        yield from totals()

    return run


def score_documents(docs, training, resident=RESIDENT, shard=SHARD, wide=WIDE, doc_id="doc_id",
                    text="text"):
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    ``training`` is a condition on ``doc_id``; rows for which it is not true are held out.
    """
    plain = only(docs, doc_id=doc_id, text=text).selectExpr(
        "cast(doc_id AS bigint) AS doc_id", "cast(text AS string) AS text")
    context = plain.sparkSession.sparkContext
    learned = plain.where(training)
    vocabulary = through_table(word_counts(learned))
    stats = vocabulary.agg(F.sum("count").alias("n"), F.count("*").alias("v"),
                           F.count_if(F.col("count") == 1).alias("once"),
                           F.count_if(F.col("count") == 2).alias("twice")).first()
    n, v = stats["n"] or 0, stats["v"]
    # At most ``resident`` words can have this share of all tokens.
    most = vocabulary.where(F.col("count") >= F.lit(n / resident)).toPandas()
    residents = Residents(most["word"], most["count"])
    known = context.broadcast(residents)

    shards = max(1, -(-n // shard))
    frequent = np.flatnonzero(residents.counts > wide).astype(np.uint64)
    words, ways = [], []
    pairs = None
    if len(frequent):
        pairs = through_table(frequent_pairs(learned, known, context.broadcast(frequent)))
        # In so many ways that copies of a word's pairs are no more than its tokens.
        spans = pairs.groupBy("word").agg(
            F.expr(f"least(ceil(sum(count) / {wide}), floor(sum(count) / count(*)), {shards})")
            .cast("bigint").alias("ways")).where("ways > 1").toPandas()
        words, ways = spans["word"].tolist(), spans["ways"].tolist()
    spread = context.broadcast(Spread(shards, words, ways))

    first_discount = (stats["once"] + 0.5) / (stats["once"] + 2 * stats["twice"] + 1)
    unknown = (first_discount * v + 1) / (n + 1)

    def base_of(counts):
        return np.log10((counts + 1) / (n + v + 1))

    def first_order(counts):
        return (counts - first_discount) / (n + 1)

    blocks = plain.select("doc_id", "text", F.coalesce(training, F.lit(False)).alias("learned")) \
        .mapInArrow(tidy(send_runs(known, spread, base_of)), _SENT)
    if words:
        blocks = blocks.union(pairs.where(F.col("word").isin(words)).mapInArrow(
            tidy(send_pairs(spread)), _SENT))
    parts = blocks.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(
        tidy(score_shards(known, spread, first_order)), _PARTS)

    # A rare code has the hash without its first bit.
    rare = vocabulary.select(
        F.col("word").bitwiseAND(F.lit((1 << 63) - 1)).alias("known_word"),
        F.col("count").alias("known_count")).where(F.col("known_count") < F.lit(n / resident))
    met = parts.join(rare, (F.col("word") == F.col("known_word")) & F.col("n").isNotNull(), "left")
    c = F.coalesce("known_count", F.lit(0))
    found, own = F.col("known_count").isNotNull(), F.col("n").isNotNull()
    p1 = F.when(found, (c - F.lit(first_discount)) / F.lit(float(n + 1))).otherwise(
        F.lit(float(unknown)))
    each = met.select(
        "uid", "doc_id", "tokens",
        F.when(~own, F.col("known")).when(found, F.col("n")).otherwise(F.lit(0)).alias("known"),
        F.when(~own, F.col("base")).otherwise(
            F.col("n") * F.log10((c + 1) / F.lit(float(n + v + 1)))).alias("base"),
        F.when(~own, F.col("score")).otherwise(
            F.col("n") * F.log10(F.col("a") + F.col("b") * p1)).alias("score"),
    )
    totals = each.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.max("tokens").alias("n_tokens"),
        F.sum("known").alias("n_known"), F.sum("base").alias("base_score"),
        F.sum("score").alias("score"))
    return totals.select(
        "doc_id", F.coalesce(~training, F.lit(True)).alias("held_out"), "n_tokens", "n_known",
        F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")
