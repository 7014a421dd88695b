"""Periodic runs of words, found by string synchronising sets.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are identical) of at least
``max(LEAST, EXPONENT * q)`` words that cannot be extended. All of them are found, of every period.

* Words become numbers, equal words equal numbers. Prefix doubling gives every place a name for the
  2, 4, 8, ... words that start there.
* At scale ``t`` (a power of two) the synchronising set holds the places whose name, or the name ``t``
  words on, is least in hash order among the places between, highly periodic places left out. Whether
  a place belongs depends on the ``2 t`` words from it alone, so equal contexts are marked alike, and
  wherever the text isn't highly periodic, one of ``t`` neighbouring places is marked.
* Marked places with equal contexts of ``2 t`` words, next to each other in the order of the text,
  propose their distance as a period if it is from ``t`` to below ``2 t``. A run with such a period
  always has two such neighbours: its words are not highly periodic at that scale, so one of its
  first ``t`` places is marked, and so is the one a period later. Between them the context can't
  recur, or the period were not the smallest.
* Each proposal is extended word by word to both sides; those too short are dropped.
* The highly periodic places (``t`` words of period ``t / 4`` or less) lie in runs of smaller periods,
  which are known when the scale's turn comes. Periods below ``DIRECT`` need no sets: there, words a
  period apart are compared directly.

Texts are worked on together, about ``CHUNK`` words at a time; a longer text is worked on alone and
whole. No row meets another, so nothing is shuffled. Names are 64-bit hashes and are compared within
one text only; a proposal is verified on the words, so a collision can hide a run but not make one.

Defined results: a null text is empty and has no runs, nor has one without words. Equal rows have
equal results. Of two stretches that are the same words, the one of the smaller period counts. An
empty table gives an empty table. Other columns of the table are not read.
"""

import numpy as np
import pyarrow as pa

from spokeframe.llm.columns import only
from spokeframe.llm.wordhash import mix, text_buffers

LEAST, EXPONENT = 6, 4

# The least scale, and so the least period that synchronising sets propose.
DIRECT = 8

CHUNK = 1 << 17

_NONE = np.uint64((1 << 64) - 1)
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def least_length(period):
    return np.maximum(LEAST, EXPONENT * period)


def direct_runs(ids, end, period):
    """``start, end`` of all maximal stretches with that period, of one array of many texts.

    ``end`` is the end of each place's text.
    """
    n = len(ids) - period
    if n <= 0:
        return np.zeros((0, 2), dtype=np.int64)
    same = np.zeros(n + 2, dtype=np.int8)
    same[1:-1] = (ids[:-period] == ids[period:]) & (end[:-period] == end[period:])
    change = np.flatnonzero(np.diff(same)).reshape(-1, 2)
    change[:, 1] += period
    return change[change[:, 1] - change[:, 0] >= least_length(period)]


def window_least(values, width):
    """Least of every ``width`` neighbours, by least values from block borders to both sides."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, _NONE)
    padded[:len(values)] = values
    grid = padded.reshape(blocks, width)
    upto = np.minimum.accumulate(grid, axis=1).ravel()
    onward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(onward[:n], upto[width - 1:width - 1 + n])


def synchronising_set(names, end, scale, periodic):
    """The places of the set; ``periodic`` lists stretches ``start, end`` of highly periodic places."""
    n = len(names)
    place = np.arange(n)
    order = np.where(place + scale <= end, names, _NONE)
    for first, last in periodic:
        order[first:last - scale + 1] = _NONE
    least = window_least(order, scale + 1)
    m = len(least)
    marked = (least != _NONE) & ((order[:m] == least) | (order[scale:scale + m] == least))
    marked &= place[:m] + 2 * scale <= end[:m]
    return np.flatnonzero(marked)


def proposals(places, context, end, scale):
    """``place, period``: neighbours of equal context in one text, a period of the scale apart."""
    by_context = np.argsort(context[places], kind="stable")
    ordered = places[by_context]
    one, other = ordered[:-1], ordered[1:]
    period = other - one
    fit = (context[one] == context[other]) & (end[one] == end[other])
    fit &= (period >= scale) & (period < 2 * scale)
    found = np.column_stack([one[fit], period[fit]])
    return found[np.lexsort((found[:, 0], found[:, 1]))]


def _agreement(one, other):
    """How many leading elements of two arrays are equal, looking at more and more of them."""
    at, step = 0, 64
    while at < len(one):
        same = one[at:at + step] == other[at:at + step]
        if not same.all():
            return at + int(same.argmin())
        at, step = at + step, 2 * step
    return len(one)


def extended(ids, first, last, place, period):
    """The maximal stretch of that period around ``place``, within ``first`` to ``last``."""
    right = _agreement(ids[place:last - period], ids[place + period:last])
    left = _agreement(ids[first:place][::-1], ids[first + period:place + period][::-1])
    return place - left, place + right + period


def runs_of(ids, begins):
    """Every run of every text: rows ``text, start, length, period``, sorted.

    ``ids`` holds the words of all the texts, and text ``i`` those from ``begins[i]`` to
    ``begins[i + 1]``.
    """
    sizes = np.diff(begins)
    end = np.repeat(begins[1:], sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    found = {}
    for period in range(1, DIRECT):
        for start, stop in direct_runs(ids, end, period).tolist():
            found.setdefault((start, stop), period)
    names, scale, place = mix(ids.astype(np.uint64) * _LEFT + _RIGHT), 1, np.arange(len(ids))
    base = place  # where the places of the longer texts are among all
    while True:
        # Only texts that are long enough for a run of the scale go on.
        long_enough = np.repeat(sizes >= EXPONENT * scale, sizes)[base]
        if scale >= DIRECT and not long_enough.all():
            names, base = names[long_enough], base[long_enough]
        if not len(base) or scale > sizes.max(initial=0):
            break
        # Ends and starts of the texts that are left, counted among the places that are left.
        own = text[base]
        change = np.flatnonzero(np.diff(own)) + 1
        starts = np.concatenate([[0], change])
        ends = np.append(change, len(own))
        size_left = ends - starts
        local_end, local_start = np.repeat(ends, size_left), np.repeat(starts, size_left)
        context = np.full(len(names), _NONE)
        context[:-scale or None] = mix(names[:-scale] * _LEFT + names[scale:] * _RIGHT)
        if scale >= DIRECT:
            moved = np.full(len(ids), -1, dtype=np.int64)
            moved[base] = np.arange(len(base))
            periodic = [(moved[s], moved[s] + e - s) for (s, e), q in found.items()
                        if EXPONENT * q <= scale <= e - s and moved[s] >= 0]
            places = synchronising_set(names, local_end, scale, periodic)
            left_ids = ids[base]
            done_period, done_end = 0, 0
            for at, period in proposals(places, context, local_end, scale).tolist():
                if period == done_period and at + period < done_end:
                    continue
                start, stop = extended(
                    left_ids, int(local_start[at]), int(local_end[at]), at, period)
                done_period, done_end = period, stop
                if stop - start >= least_length(period):
                    shift = int(base[start]) - start
                    found.setdefault((start + shift, stop + shift), period)
        names, scale = context, 2 * scale
    if not found:
        return np.zeros((0, 4), dtype=np.int64)
    rows = np.array([(text[s], s - begins[text[s]], e - s, q) for (s, e), q in found.items()],
                    dtype=np.int64)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def repeats(rows, size):
    """Which of ``size`` words a run holds after its first period."""
    edge = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edge, rows[:, 0] + rows[:, 2], 1)
    np.add.at(edge, rows[:, 0] + rows[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _judged(words):
    """``runs, collapsed`` of texts given as lists of words."""
    begins = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    every = pa.array([w for of_text in words for w in of_text], pa.large_binary())
    ids = every.dictionary_encode().indices.to_numpy().astype(np.int64)
    rows = runs_of(ids, begins)
    of_text = np.searchsorted(rows[:, 0], np.arange(len(words) + 1))
    for i, said in enumerate(words):
        own = rows[of_text[i]:of_text[i + 1], 1:]
        if len(own):
            said = [w for w, gone in zip(said, repeats(own, len(said)).tolist()) if not gone]
        yield own, b" ".join(said)


def _out(batch, words):
    runs, collapsed = zip(*_judged(words))
    lengths = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
    flat = np.concatenate(runs)
    structs = pa.StructArray.from_arrays(
        [pa.array(flat[:, k], pa.int64()) for k in range(3)], fields=list(_RUNS.value_type))
    return pa.RecordBatch.from_arrays([
        *batch.columns, pa.array([len(w) for w in words], pa.int64()),
        pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), structs),
        pa.array(collapsed, pa.string()),
    ], names=[*batch.schema.names, "n_words", "runs", "collapsed"])


def _find(batches):
    for batch in batches:
        kept = batch.select(["doc_id"])
        data, offsets = text_buffers(batch.column("text"))
        held, first, used = [], 0, 0
        for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            # Splits at the six ASCII blanks.
            held.append(data[lo:hi].tobytes().split())
            used += len(held[-1])
            if used >= CHUNK:
                yield _out(kept.slice(first, len(held)), held)
                held, first, used = [], first + len(held), 0
        if held:
            yield _out(kept.slice(first, len(held)), held)


def periodic_runs(docs, doc_id="doc_id", text="text"):
    """``doc_id, n_words, runs, collapsed`` of every document.

    ``runs`` lists ``start, length, period`` by start, then period, in words from 0; ``collapsed`` is
    the text's words without what a run repeats after its first period, joined by one space.
    """
    plain = only(docs, doc_id=doc_id, text=text)
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.selectExpr("doc_id", "cast(text AS string) AS text").mapInArrow(
        _find, f"doc_id {kind}, n_words bigint, "
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
