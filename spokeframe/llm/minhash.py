"""Near-duplicate documents by bottom-k sketches.

A document is its set of distinct five-word shingles, hashed once to 64 bits. Its sketch is the
``SKETCH`` least hashes. Documents with equal sets form a class, and all work from there on is on
one set per class, so exact copies cost nothing however many there are.

* Inverted lists. The least ``INDEXED`` hashes of a class are retained for the lists. Two sets of
  the wanted similarity share at least ``SHARED`` of them (but for a chance of one in a million at the
  threshold itself), so they also share one of the ``INDEXED - SHARED + 1`` that are rarest in the
  whole table. Only those rare ones are indexed; what a common passage leaves in thousands of
  documents is in no list unless it makes up half of them.
* Overlaps. The classes of a list are compared by their sketches: the least values of the union of
  two sketches are a sample of the union of the sets, and the share of them in both estimates the
  similarity. Pairs that the estimate allows (4.5 standard errors below the threshold) are candidates.
* Confirmation. Candidates are compared by their full sets.

Lists of thousands would give millions of candidates where few are needed, for only the components
matter. So the lists are gone through twice. The first time each class names its few likeliest
partners; what is confirmed is joined to components. The second time all candidates between
different components, and only those, are named and confirmed. No link between components is left out.

A long list is cut into blocks, and every pair of blocks is compared in a task of its own.

Defined results: a null text is empty; a document without words has no shingles and is linked with
nothing; one of fewer than five words is one shingle. Repeated rows are copies like others. Null ids
are no smallest id; a component of null ids only has a null id.
"""

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spokeframe.llm.columns import only
from spokeframe.llm.components import components
from spokeframe.llm.wordhash import chunks, hashed_words, mix
from spokeframe.llm.workers import tidy
from spokeframe.session import through_table

WORDS = 5
SKETCH = 256
INDEXED, SHARED = 24, 11
BLOCK = 2048

# The first time, partners that each class names per list, and its rarest lists that are read.
FIRST_PARTNERS, FIRST_LISTS = 3, 3

# Bits of a sketch as a bitmap, in words of 64.
BITMAP_WORDS = 32

# Bits of the filter that spares most documents the second reading, and of each of its pieces.
FILTER_BITS, PIECE_BITS = 1 << 23, 1 << 15

_SKETCHED = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("tie", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("set_id", T.BinaryType()),
    T.StructField("low", T.ArrayType(T.LongType())),
    T.StructField("sketch", T.BinaryType()),
])
_MULTIPLIERS = mix(np.arange(1, WORDS + 2, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(column):
    """For every text of an Arrow column, its distinct shingles' hashes in order."""
    for first, last, data, offsets in chunks(column):
        words, begins = hashed_words(data, offsets)
        grams = np.zeros(max(len(words) - WORDS + 1, 0), dtype=np.uint64)
        for j in range(WORDS):
            grams += words[j:j + len(grams)] * _MULTIPLIERS[j]
        grams = mix(grams)
        for lo, hi in zip(begins[:-1].tolist(), begins[1:].tolist()):
            if hi - lo >= WORDS:
                yield np.unique(grams[lo:hi - WORDS + 1])
            elif hi > lo:
                terms = np.append(words[lo:hi] * _MULTIPLIERS[:hi - lo],
                                  _MULTIPLIERS[WORDS:] * np.uint64(hi - lo))
                yield mix(terms.sum(dtype=np.uint64, keepdims=True))
            else:
                yield words[:0]


def _set_id(hashes):
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _sketched(batches):
    for batch in batches:
        rows = []
        for hashes in shingle_sets(batch.column("text")):
            if len(hashes):
                rows.append((len(hashes), _set_id(hashes), hashes[:INDEXED].view(np.int64),
                             (hashes[:SKETCH] >> np.uint64(32)).astype("<u4").tobytes()))
            else:
                rows.append((0, None, None, None))
        n, ids, low, sketch = zip(*rows) if rows else ((),) * 4
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("tie"), pa.array(n, pa.int64()), pa.array(ids, pa.binary()),
            pa.array(low, pa.list_(pa.int64())), pa.array(sketch, pa.binary()),
        ], names=_SKETCHED.names)


def sketches(docs):
    return docs.mapInArrow(tidy(_sketched), _SKETCHED)


def shared_at_least(size, threshold):
    """How many of ``size`` retained hashes two sets of that similarity share at least."""
    if size >= INDEXED:
        return SHARED
    return max(1, math.ceil(size * (threshold - 0.05)))


def inverted_lists(classes, threshold):
    """``value, part, set_id, nth, block, n, sketch``: the lists of the rare retained values.

    ``nth`` counts a class's lists from its rarest value on; ``part`` is a pair of blocks.
    """
    retained = classes.select("set_id", F.size("low").alias("kept"), F.explode("low").alias("value"))
    frequency = retained.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    wanted = F.element_at(
        F.array(*(F.lit(s - shared_at_least(s, threshold) + 1) for s in range(1, INDEXED + 1))),
        F.col("kept"))
    rare = (
        retained.join(frequency, "value").groupBy("set_id")
        .agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("values"),
             F.first("kept").alias("kept"))
        # Values of this class alone are rarer still and come first, though they have no list.
        .withColumn("take", wanted - (F.col("kept") - F.size("values"))).where("take > 0")
        .select("set_id", F.posexplode(F.slice("values", F.lit(1), F.col("take"))).alias("nth", "v"))
        .select("set_id", "nth", "v.df", "v.value")
    )
    blocks = F.ceil(F.col("df") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("set_id"), blocks).cast("int")
    # Block pairs (low, high) that the own block is one of.
    parts = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.least(own, b) * blocks
                        + F.greatest(own, b))
    return (
        rare.select("set_id", "value", "nth", F.explode(parts).alias("part"), own.alias("block"))
        .join(classes.select("set_id", "n", "sketch"), "set_id")
    )


def _least_estimate(threshold, whole, union):
    """Estimates below this are no candidates. A sample of the whole union has no error."""
    left = np.maximum(union - SKETCH, 0) / np.maximum(union - 1, 1)
    error = np.sqrt(threshold * (1 - threshold) / SKETCH * left)
    return threshold - 0.01 - 4.5 * np.where(whole, 0, error)


def estimates(one, other, n_one, n_other):
    """Union-sketch estimates of pairs: rows of padded sketches, and the sizes of the sets."""
    both = np.sort(np.concatenate([one, other], axis=1), axis=1)
    twice = np.zeros(both.shape, dtype=bool)
    twice[:, 1:] = both[:, 1:] == both[:, :-1]
    twice &= both != _PAD
    rank = np.cumsum(~twice & (both != _PAD), axis=1)
    distinct = rank[:, -1]
    cut = np.where((n_one > SKETCH) | (n_other > SKETCH), np.minimum(distinct, SKETCH), distinct)
    return (twice & (rank <= cut[:, None])).sum(axis=1) / np.maximum(cut, 1)


_PAD = np.uint64(1 << 40)


def _bitmaps(sketches_, lengths):
    """Sketches as sets of bits."""
    bits = np.zeros((len(sketches_), BITMAP_WORDS), dtype=np.uint64)
    row = np.repeat(np.arange(len(sketches_)), lengths)
    value = sketches_[np.arange(sketches_.shape[1])[None, :] < lengths[:, None]]
    spot = mix(value) % np.uint64(64 * BITMAP_WORDS)
    np.bitwise_or.at(bits, (row, (spot >> np.uint64(6)).astype(np.int64)),
                     np.uint64(1) << (spot & np.uint64(63)))
    return bits


def _likely_pairs(sketches_, lengths, n, roots, threshold):
    """Pairs of different roots in a long list whose bitmaps share enough for a candidate.

    Pairs within the root that most members have are not even looked at.
    """
    names, root, members = np.unique(roots, return_inverse=True, return_counts=True)
    largest = members.argmax()
    left = np.flatnonzero(root != largest) if members[largest] > 1 else np.arange(len(roots))
    bits = _bitmaps(sketches_, lengths)
    lost = lengths - np.bitwise_count(bits).sum(axis=1)
    for at in range(0, len(left), 64):
        rows = left[at:at + 64]
        shared = np.zeros((len(rows), len(lengths)), dtype=np.int32)
        for word in range(BITMAP_WORDS):
            shared += np.bitwise_count(bits[rows, word, None] & bits[None, :, word])
        one, other = n[rows, None], n[None, :]
        least = _least_estimate(threshold, (one <= SKETCH) & (other <= SKETCH),
                                (one + other) / (1 + threshold))
        longer = np.maximum(lengths[rows, None], lengths[None, :])
        i, j = np.nonzero(shared + lost[rows, None] >= least * longer)
        i = rows[i]
        # Both ends among the rows: once.
        keep = (root[i] != root[j]) & ((i < j) | ((root[j] == largest) & (members[largest] > 1)))
        yield i[keep], j[keep]


def _list_pairs(bounds, sketches_, lengths, n, roots, apart, threshold):
    """Index pairs to estimate, of all the lists between ``bounds``."""
    sizes = np.diff(bounds)
    for size in np.unique(sizes[sizes > 1]):
        begins = bounds[:-1][sizes == size]
        if size <= 32:
            i, j = np.triu_indices(size, 1)
            i, j = (begins[:, None] + i).ravel(), (begins[:, None] + j).ravel()
            keep = apart(i, j)
            yield i[keep], j[keep]
        else:
            for begin in begins.tolist():
                end = begin + int(size)
                for i, j in _likely_pairs(
                        sketches_[begin:end], lengths[begin:end], n[begin:end], roots[begin:end],
                        threshold):
                    i, j = i + begin, j + begin
                    keep = apart(i, j)
                    yield i[keep], j[keep]


def _likeliest(i, j, estimate, partners):
    """Of the pairs, those that are among the likeliest ``partners`` of either end."""
    ends, pair = np.concatenate([i, j]), np.tile(np.arange(len(i)), 2)
    order = np.lexsort((-estimate[pair], ends))
    ends, pair = ends[order], pair[order]
    first = np.flatnonzero(np.concatenate([[True], ends[1:] != ends[:-1]]))
    nth = np.arange(len(ends)) - np.repeat(first, np.diff(np.append(first, len(ends))))
    return np.unique(pair[nth < partners])


def _candidates(threshold, partners):
    """Reader of sorted lists: yields candidate pairs ``a, b`` by set id."""
    def compare(lists):
        key = lists["value"].to_numpy(), lists["part"].to_numpy()
        change = (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])
        bounds = np.concatenate([[0], np.flatnonzero(change) + 1, [len(lists)]])
        raw = [np.frombuffer(s, dtype="<u4") for s in lists["sketch"]]
        lengths = np.array([len(s) for s in raw], dtype=np.int64)
        padded = np.full((len(raw), SKETCH), _PAD, dtype=np.uint64)
        padded[np.arange(SKETCH)[None, :] < lengths[:, None]] = np.concatenate(raw)
        n = lists["n"].to_numpy()
        ids, block = lists["set_id"].to_numpy(), lists["block"].to_numpy()
        roots = lists["root"].to_numpy()
        # In a part of two blocks only pairs across them; within one block its own part has them.
        mixed = np.repeat(np.maximum.reduceat(block, bounds[:-1])
                          != np.minimum.reduceat(block, bounds[:-1]), np.diff(bounds))

        def apart(i, j):
            keep = ~mixed[i] | (block[i] != block[j])
            keep &= np.minimum(n[i], n[j]) >= (threshold - 1e-9) * np.maximum(n[i], n[j])
            return keep & (roots[i] != roots[j])

        for i, j in _list_pairs(bounds, padded, lengths, n, roots, apart, threshold):
            kept_i, kept_j, kept_e = [], [], []
            for at in range(0, len(i), 20_000):
                a, b = i[at:at + 20_000], j[at:at + 20_000]
                e = estimates(padded[a], padded[b], n[a], n[b])
                union = (n[a] + n[b]) / (1 + e)
                keep = e >= _least_estimate(
                    threshold, (n[a] <= SKETCH) & (n[b] <= SKETCH), union)
                kept_i.append(a[keep])
                kept_j.append(b[keep])
                kept_e.append(e[keep])
            if not kept_i:
                continue
            a, b, e = map(np.concatenate, (kept_i, kept_j, kept_e))
            if partners and len(a):
                best = _likeliest(a, b, e, partners)
                a, b = a[best], b[best]
            if len(a):
                swap = ids[a] > ids[b]
                yield pd.DataFrame({"a": np.where(swap, ids[b], ids[a]),
                                    "b": np.where(swap, ids[a], ids[b])})

    def run(frames):
        held = None
        for frame in frames:
            if held is not None:
                frame = pd.concat([held, frame], ignore_index=True)
            if not len(frame):
                continue
            # The last list may go on in the next frame.
            last = (frame["value"] == frame["value"].iloc[-1]) & (
                frame["part"] == frame["part"].iloc[-1])
            cut = int(last.to_numpy().argmax())
            held = frame.iloc[cut:]
            if cut:
                yield from compare(frame.iloc[:cut])
        if held is not None:
            yield from compare(held)

    return run


def candidates(lists, threshold, partners=None):
    """Distinct candidate pairs ``a, b`` of the lists (with ``root``, pairs of one root left out)."""
    ordered = lists.repartition("value", "part").sortWithinPartitions("value", "part")
    return ordered.mapInPandas(
        tidy(_candidates(threshold, partners)), "a binary, b binary").distinct()


def _sets_of(pairs, docs, classes):
    """``set_id, hashes`` of the sets in ``pairs``, computed from the documents once more.

    A bitmap of one megabyte, whatever the table's size, spares most other documents the work; a
    document that slips through is dropped by the join.
    """
    wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    named = through_table(classes.join(wanted, "set_id").select("set_id", "doc_id", "null_id"))
    position = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1).cast("bigint"))), F.lit(FILTER_BITS))
    pieces = named.select(position.alias("at")).groupBy(
        F.floor(F.col("at") / PIECE_BITS).alias("piece")).agg(
        F.bitmap_construct_agg(F.col("at") % PIECE_BITS).alias("bits")).collect()
    bits = np.zeros((FILTER_BITS // PIECE_BITS, PIECE_BITS // 8), dtype=np.uint8)
    for row in pieces:
        bits[row["piece"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits.ravel().tobytes())

    def read(batches):
        flags = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            at = batch.column("at").to_numpy()
            hit = np.flatnonzero(flags[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            if not len(hit):
                continue
            batch = batch.take(pa.array(hit))
            sets = list(shingle_sets(batch.column("text")))
            ids = [_set_id(s) if len(s) else None for s in sets]
            for lo in range(0, len(sets), 256):
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, 256), pa.array(ids[lo:lo + 256], pa.binary()),
                    pa.array([s.view(np.int64) for s in sets[lo:lo + 256]], pa.list_(pa.int64())),
                ], names=["doc_id", "set_id", "hashes"])

    sets = docs.select("doc_id", "text", position.alias("at")).mapInArrow(
        tidy(read), "doc_id bigint, set_id binary, hashes array<bigint>")
    one_each = named.withColumnsRenamed({"doc_id": "first_id", "set_id": "first_set"})
    met = sets.join(one_each, (F.col("set_id") == F.col("first_set")) & (
        F.col("doc_id").eqNullSafe(F.col("first_id"))))
    # A repeated row gives its set again; one is enough.
    return through_table(met.select("set_id", "hashes").dropDuplicates(["set_id"]))


def confirm(pairs, docs, classes, percent):
    """The pairs with ``100 * intersection >= percent * union``, by full sets."""
    sets = _sets_of(pairs, docs, classes)
    one = sets.select(F.col("set_id").alias("a"), F.col("hashes").alias("of_a"))
    other = sets.select(F.col("set_id").alias("b"), F.col("hashes").alias("of_b"))
    both = pairs.join(one, "a").join(other, "b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - shared
    return through_table(both.where(shared * 100 >= union * percent).select("a", "b"))


def near_duplicates(docs, percent=85, doc_id="doc_id", text="text"):
    """``doc_id, tie, n_shingles, component_id, kept`` of every document.

    ``tie`` hashes the text; with the id it tells rows apart.
    """
    threshold = percent / 100
    plain = only(docs, doc_id=doc_id, text=text).selectExpr(
        "cast(doc_id AS bigint) AS doc_id", "cast(text AS string) AS text").withColumn(
        "tie", F.xxhash64("text"))
    sketched = through_table(sketches(plain))
    classes = through_table(
        sketched.where("set_id IS NOT NULL").groupBy("set_id")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("low").alias("low"),
             F.first("sketch").alias("sketch"))
        .withColumn("null_id", F.col("doc_id").isNull()))
    lists = through_table(inverted_lists(classes, threshold))
    first = through_table(candidates(
        lists.where(F.col("nth") < FIRST_LISTS).withColumn("root", F.hex("set_id")),
        threshold, FIRST_PARTNERS))
    links = confirm(first, plain, classes, percent)
    joined = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    rooted = lists.join(joined.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "root", F.hex(F.coalesce("root", "set_id")))
    second = through_table(candidates(rooted, threshold).join(first, ["a", "b"], "left_anti"))
    more = confirm(second, plain, classes, percent)
    final = components(
        joined.select(F.col("node").alias("u"), F.col("root").alias("v"))
        .union(more.select("a", "b")))
    member = classes.select("set_id", F.col("doc_id").alias("least_id")).join(
        final.withColumnRenamed("node", "set_id"), "set_id", "left")
    member = member.withColumn("root", F.coalesce("root", "set_id"))
    named = member.join(
        member.groupBy("root").agg(F.min("least_id").alias("component_id")), "root"
    ).select("set_id", "component_id")
    linked = sketched.join(named, "set_id", "left").withColumn(
        "component_id", F.when(F.col("set_id").isNull(), F.col("doc_id"))
        .otherwise(F.col("component_id")))
    return linked.select(
        "doc_id", "tie", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def first_of_each(docs, percent=80):
    """One document of each group of near-duplicates, with its own columns.

    It is the one with the least id; of several rows of that id and text, one.
    """
    kept = near_duplicates(docs, percent).where("kept").groupBy("doc_id", "tie").agg(
        F.count("*").alias("__times")).withColumnsRenamed(
        {"doc_id": "__kept_id", "tie": "__kept_tie"})
    tie = F.xxhash64(docs["text"].cast("string"))
    found = docs.join(kept, docs["doc_id"].cast("bigint").eqNullSafe(kept["__kept_id"])
                      & (tie == kept["__kept_tie"]))
    once = found.where(F.col("__times") == 1)
    repeated = found.where(F.col("__times") > 1).dropDuplicates(["__kept_id", "__kept_tie"])
    return once.unionByName(repeated).select(*docs.columns)
