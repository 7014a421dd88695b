"""Pack tokenised documents into sequences of a fixed length by minimum bin slack.

Each task tokenises its documents in batches. What fills whole sequences is cut off as such; the
remainders of a batch, all shorter than a sequence, are packed together. For each sequence the
longest remainder is taken and a subset-sum table, kept as the bits of one integer, shows which
totals the others can make beside it; the best total is traced back to how many of each length it
takes, and the same multiset is used as long as its lengths last. A batch's last sequences that stay
short are cut at powers of two, which need no padding.

Memory is bounded by the batch (``batch_tokens``) and one document. Sequence numbers combine the
task's and the sequence's own. Nothing is shuffled.

Defined results: a null text is empty and so one piece with the end token alone; every row is packed,
repeated ones as often as they stand there.
"""

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import types as T

from spokeframe.llm.workers import tidy

LENGTH = 1024
END = 0
BATCH_TOKENS = 2_000_000

# Distinct chunks of text whose ids a worker remembers.
REMEMBERED = 300_000

# New chunks of each batch that are encoded both ways and compared, where ranks are given.
COMPARED = 50

# Rows taken from and passed on to Spark at once.
TEXTS_AT_ONCE, PIECES_AT_ONCE = 250, 2000

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids", T.BinaryType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
])

_ARROW = pa.schema([(f.name, pa.binary() if f.name == "ids" else pa.int64()) for f in PIECES])


# White space other than the blank and the line feed.
_OTHER_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class ChunkEncoder:
    """Encode texts with a byte-level BPE whose words start at single blanks.

    Such a tokenizer never joins what stands before a single blank to the blank or what follows, so
    a text's ids are those of its chunks in a row, and chunks repeat far more than texts do. Texts
    with blanks beside other white space are encoded whole. Ids are 32-bit little-endian.

    ``ranks`` and ``pattern`` give the same vocabulary to a quicker library; its ids are compared
    with the tokenizer's for some chunks, and a text encoded whole, of every batch. Texts that hold
    one of the tokenizer's added tokens are encoded by the tokenizer.
    """

    def __init__(self, path, ranks=None, pattern=None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Strings that are tokens of their own wherever they stand.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Chunks without the blank in front of them -> ids with it.
        self.known = {}
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.widths = np.zeros(max(table.values()) + 1, dtype=np.int64)
            for token, rank in table.items():
                self.widths[rank] = len(token)
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary

    def _exact(self, texts):
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, text):
        if self.fast is None:
            return self._exact([text])[0]
        return np.array(self.fast(text), dtype="<u4").tobytes()

    @staticmethod
    def _same(exact, fast):
        if exact != fast:
            raise ValueError("the ranks are not those of the tokenizer")

    def _learn(self, chunks):
        """Encode new chunks in one text; the widths of the ids show where each ends."""
        if self.fast is None:
            self.known.update(zip(chunks, self._exact([" " + chunk for chunk in chunks])))
            return
        text = " " + " ".join(chunks)
        ids = np.array(self.fast(text), dtype="<u4")
        ends = np.cumsum([len(chunk.encode()) + 1 for chunk in chunks])
        cuts = (4 * np.searchsorted(np.cumsum(self.widths[ids]), ends) + 4).tolist()
        ids = ids.tobytes()
        self.known.update(zip(chunks, map(ids.__getitem__, map(slice, [0, *cuts], cuts))))

    @staticmethod
    def uneven(text):
        return ("  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " "
                or _OTHER_SPACE.search(text) is not None)

    def encode(self, texts):
        """The ids of each text as bytes."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        known, found, compared = self.known, [], self.fast is None
        compared_uneven = compared
        for text in texts:
            if any(token in text for token in self.added):
                found.append(self._exact([text])[0])
                continue
            if not text or self.uneven(text):
                found.append(self._whole(text))
                if text and not compared_uneven:
                    self._same(self._exact([text]), found[-1:])
                    compared_uneven = True
                continue
            first, *chunks = text.split(" ")
            new = set(chunks).difference(known)
            if new:
                new = list(new)
                self._learn(new)
                if not compared:
                    some = new[:COMPARED]
                    self._same(self._exact([" " + chunk for chunk in some]), [known[c] for c in some])
                    compared = True
            found.append(self._whole(first) + b"".join(map(known.__getitem__, chunks)))
        return found


def best_fill(counts, lengths, room):
    """Of the multiset ``counts`` over ``lengths``, the one whose total is closest below ``room``.

    Returns ``{length: how many}``. Totals that can be made are bits of an integer; each step adds
    one length with its count in powers of two, and stops when the room can be filled exactly.
    """
    full, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in lengths:
        if length > room:
            continue
        left, batch = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(batch, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & full
            left -= take
            batch *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def fill_windows(counts, capacity):
    """Yield ``(multiset, times)`` that use up ``counts`` ``{length: how many}``."""
    counts = dict(counts)
    lengths = sorted(counts, reverse=True)
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        chosen = best_fill(counts, lengths, capacity - longest)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(counts[length] // n for length, n in chosen.items())
        for length, n in chosen.items():
            counts[length] -= n * times
        lengths = [length for length in lengths if counts[length]]
        yield chosen, times


def _powers_of_two(n):
    return [1 << bit for bit in range(n.bit_length() - 1, -1, -1) if n >> bit & 1]


def pack_batch(sizes, capacity=LENGTH, slack=0.02):
    """Pieces ``(document, start, length, sequence, offset)`` of documents of the given sizes.

    A sequence that more than ``slack`` of the capacity is missing from is cut at powers of two.
    """
    pieces, sequence, remainders = [], 0, {}
    for doc, size in enumerate(sizes):
        for start in range(0, size - capacity + 1, capacity):
            pieces.append((doc, start, capacity, sequence, 0))
            sequence += 1
        if size % capacity:
            remainders.setdefault(size % capacity, []).append(doc)
    for chosen, times in fill_windows({n: len(d) for n, d in remainders.items()}, capacity):
        total = sum(length * n for length, n in chosen.items())
        ends = [capacity]
        if total < capacity * (1 - slack):
            ends = list(np.cumsum(_powers_of_two(total)))
        for _ in range(times):
            at, k, begin = 0, 0, 0
            for length, n in chosen.items():
                for _ in range(n):
                    doc = remainders[length].pop()
                    start, left = sizes[doc] - length, length
                    while left:
                        take = min(left, int(ends[k]) - at)
                        pieces.append((doc, start, take, sequence, at - begin))
                        start, left, at = start + take, left - take, at + take
                        if at == ends[k] and k + 1 < len(ends):
                            begin, k, sequence = at, k + 1, sequence + 1
            sequence += 1
    return pieces, sequence


def pack(docs, tokenizer, ranks=None, pattern=None, capacity=LENGTH, end=END,
         batch_tokens=BATCH_TOKENS, doc_id="doc_id", text="text"):
    """One row per piece: ids as 32-bit little-endian bytes, and its place (``PIECES``).

    ``tokenizer``, and ``ranks`` if given, are paths of files that every machine has.
    """
    from spokeframe.llm.columns import only

    end_bytes = np.array([end], dtype="<u4").tobytes()

    def run(batches):
        encoder, serial = ChunkEncoder(tokenizer, ranks, pattern), 0
        first = TaskContext.get().partitionId() << 40

        def flush(keys, ids):
            nonlocal serial
            sizes = [len(b) // 4 for b in ids]
            pieces, used = pack_batch(sizes, capacity)
            for at in range(0, len(pieces), PIECES_AT_ONCE):
                docs, starts, lengths, sequences, offsets = zip(*pieces[at:at + PIECES_AT_ONCE])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": [keys[d] for d in docs],
                    "start": starts,
                    "length": lengths,
                    "ids": [ids[d][4 * i:4 * (i + n)] for d, i, n in zip(docs, starts, lengths)],
                    "doc_tokens": [sizes[d] for d in docs],
                    "sequence_id": [first + serial + s for s in sequences],
                    "offset": [int(o) for o in offsets],
                }, schema=_ARROW)
            serial += used

        keys, ids, held = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                found = encoder.encode(["" if t is None else t
                                        for t in part.column("text").to_pylist()])
                keys += part.column("doc_id").to_pylist()
                ids += [b + end_bytes for b in found]
                held += sum(map(len, found)) // 4 + len(found)
                if held >= batch_tokens:
                    yield from flush(keys, ids)
                    keys, ids, held = [], [], 0
        if keys:
            yield from flush(keys, ids)

    plain = only(docs, doc_id=doc_id, text=text)
    return plain.selectExpr("cast(doc_id AS bigint) AS doc_id", "cast(text AS string) AS text") \
        .mapInArrow(tidy(run), PIECES)
