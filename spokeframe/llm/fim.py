"""Fill-in-middle transformation by piece tables.

A document is a table of descriptors ``(buffer, start, end)`` over two buffers that never change: its
text in UTF-8 and the sentinels. Cutting splits a descriptor, a form arranges the descriptors and
puts sentinel descriptors between them, and the inverse permutation puts them back. Text is copied
only where an output string is asked for; hashes run over the descriptors.

Where a text is cut, and whether, follows from a digest of its id, so it is the same in every run and
on every partitioning. Cuts count code points. No row meets another: nothing is shuffled.

Restoring reads nothing but the output and its form. A text that holds a sentinel stays plain, and no
sentinel overlaps another or itself, so each of the three is found exactly where it was put.

Defined results: a null text is empty, an empty text is plain, a null id counts as the empty string.
Rows that are equal are cut alike. An empty table gives an empty table. Other columns of the table
are not read. A text of any length is cut in its own bytes; counting code points looks at ``CHUNK``
bytes at a time.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from spokeframe.llm.columns import only
from spokeframe.llm.wordhash import text_buffers

# The sentinels of prefix, suffix and middle, and the order of the parts in each form.
SENTINELS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
FORMS = {
    "psm": (("prefix", "prefix"), ("suffix", "suffix"), ("middle", "middle")),
    "spm": (("suffix", "suffix"), ("prefix", "prefix"), ("middle", "middle")),
}
PARTS = ("prefix", "middle", "suffix")

# Documents of a hundred that are transformed, and transformed ones of a hundred that go suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
SEED = 1

# Bytes that code points are counted in at once, and bytes of text in a batch that is handed on.
CHUNK, HANDED_ON = 1 << 20, 4 << 20

TEXT, MARKS = 0, 1
_MARKS = b"".join(SENTINELS.values())


class PieceTable:
    """Descriptors over immutable buffers; every operation makes descriptors, none moves text."""

    def __init__(self, text, pieces=None):
        self.buffers = (memoryview(text), memoryview(_MARKS))
        self.pieces = [(TEXT, 0, len(text))] if pieces is None else pieces

    def split(self, at):
        """The table with the descriptor that holds byte ``at`` of the content cut in two there."""
        before = 0
        for k, (buffer, start, end) in enumerate(self.pieces):
            inside = at - before
            if inside <= end - start:
                halves = [(buffer, start, start + inside), (buffer, start + inside, end)]
                return PieceTable(self.buffers[TEXT], self.pieces[:k] + halves + self.pieces[k + 1:])
            before += end - start
        raise IndexError(at)

    def arranged(self, order):
        """The descriptors in the order given, by index."""
        return PieceTable(self.buffers[TEXT], [self.pieces[i] for i in order])

    def marked(self, names):
        """A sentinel's descriptor before each of the descriptors."""
        pieces = []
        for name, piece in zip(names, self.pieces):
            at = _MARKS.index(SENTINELS[name])
            pieces += [(MARKS, at, at + len(SENTINELS[name])), piece]
        return PieceTable(self.buffers[TEXT], pieces)

    def stream(self):
        for buffer, start, end in self.pieces:
            yield self.buffers[buffer][start:end]

    def sha256(self):
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part)
        return digest.hexdigest()

    def content(self):
        return b"".join(self.stream())


def _begins(block):
    """Where code points begin in UTF-8 bytes."""
    return (block & 0xC0) != 0x80


def code_points(data):
    return sum(int(np.count_nonzero(_begins(data[lo:lo + CHUNK])))
               for lo in range(0, len(data), CHUNK))


def byte_offset(data, units):
    """The byte at which code point number ``units`` begins, the length if there is none."""
    for lo in range(0, len(data), CHUNK):
        begins = _begins(data[lo:lo + CHUNK])
        n = int(np.count_nonzero(begins))
        if units < n:
            return lo + int(np.flatnonzero(begins)[units])
        units -= n
    return len(data)


def draws(id_text, seed=SEED):
    """Four numbers below 2**32 from a digest of seed and id."""
    digest = hashlib.sha256(f"{seed}:{id_text}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def plan(data, text, id_text, seed=SEED, transformed=TRANSFORMED, suffix_first=SUFFIX_FIRST):
    """``n, form, prefix, middle, table`` of one text (``data`` and ``text`` are the same bytes)."""
    n = code_points(data)
    one, other, whether, which = draws(id_text, seed)
    whole = PieceTable(text)
    if not n or whether % 100 >= transformed or any(s in text for s in SENTINELS.values()):
        return n, "plain", None, None, whole
    form = "spm" if which % 100 < suffix_first else "psm"
    first, last = sorted((one % (n + 1), other % (n + 1)))
    # ASCII texts need no counting: a code point is a byte.
    begin, end = (first, last) if n == len(data) else (byte_offset(data, x) for x in (first, last))
    cut = whole.split(end).split(begin)
    order = [PARTS.index(part) for _, part in FORMS[form]]
    return n, form, first, last - first, cut.arranged(order).marked([m for m, _ in FORMS[form]])


def invert(output, form):
    """The table of the text that an output of that form was made from."""
    if form == "plain":
        return PieceTable(output)
    pieces, at = [], 0
    for mark, _ in FORMS[form]:
        found = output.index(SENTINELS[mark], at)
        if pieces:
            pieces[-1] = (TEXT, at, found)
        at = found + len(SENTINELS[mark])
        pieces.append((TEXT, at, len(output)))
    arranged = [part for _, part in FORMS[form]]
    return PieceTable(output, pieces).arranged([arranged.index(part) for part in PARTS])


def _texts(column):
    """Every text of an Arrow column as its bytes, and as an array over the same bytes."""
    data, offsets = text_buffers(column)
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield data[lo:hi], data[lo:hi].tobytes()


def _handed_on(batch, rows, names, types, weigh):
    """Batches of the old columns and the new ones, each of about ``HANDED_ON`` bytes of new text."""
    def out(first, held):
        columns = [pa.array(values, kind) for values, kind in zip(zip(*held), types)]
        return pa.RecordBatch.from_arrays(
            [*batch.slice(first, len(held)).columns, *columns], names=[*batch.schema.names, *names])

    first, held, used = 0, [], 0
    for row in rows:
        held.append(row)
        used += len(row[weigh])
        if used >= HANDED_ON:
            yield out(first, held)
            first, held, used = first + len(held), [], 0
    if held:
        yield out(first, held)


def transform(docs, doc_id="doc_id", text="text", seed=SEED, transformed=TRANSFORMED,
              suffix_first=SUFFIX_FIRST):
    """``doc_id, n, form, prefix_chars, middle_chars, output, output_sha256`` of every document."""
    plain = only(docs, doc_id=doc_id, text=text).select(
        "doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id_text"),
        F.col("text").cast("string").alias("text"))
    names = ("n", "form", "prefix_chars", "middle_chars", "output", "output_sha256")
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())

    def run(batches):
        for batch in batches:
            ids = batch.column("id_text").to_pylist()
            kept = batch.select(["doc_id"])

            def rows():
                for id_text, (data, said) in zip(ids, _texts(batch.column("text"))):
                    *told, table = plan(data, said, id_text, seed, transformed, suffix_first)
                    yield *told, table.content(), table.sha256()

            yield from _handed_on(kept, rows(), names, types, names.index("output"))

    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(
        run, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
        "output string, output_sha256 string")


def restore(rows, output="output", form="form"):
    """Add ``restored`` and ``restored_sha256``: the exact texts, from outputs and forms alone."""
    names, types = ("restored", "restored_sha256"), (pa.string(), pa.string())

    def run(batches):
        for batch in batches:
            forms = batch.column(form).to_pylist()

            def texts():
                for kind, (_, said) in zip(forms, _texts(batch.column(output))):
                    table = invert(said, kind)
                    yield table.content(), table.sha256()

            yield from _handed_on(batch, texts(), names, types, 0)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, restored string, restored_sha256 string")
