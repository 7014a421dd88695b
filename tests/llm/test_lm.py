"""The Elias-Fano levels against dictionaries, and the model against one counted in plain Python."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spokeframe.llm import lm
from spokeframe.llm.eliasfano import Level, Sequence

WORD = re.compile(r"[^ \t-\r]+")
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}
TRAINING = "coalesce(crc32(cast(doc_id AS string)) % 7 != 2, true)"


def as_bytes(data):
    return np.frombuffer(data, dtype=np.uint8)


def test_sequences_find_what_is_there():
    rng = np.random.default_rng(3)
    for n, universe in ((0, 10), (1, 1), (500, 600), (64, 64), (3000, 10**9), (40000, 2**45)):
        numbers = np.unique(rng.integers(0, universe, 2 * n))[:n]
        sequence = Sequence(as_bytes(Sequence.encode(numbers, universe)))
        assert sequence.get(np.arange(len(numbers))).tolist() == numbers.tolist()
        asked = np.concatenate([numbers, rng.integers(-5, 2 * universe, 200)])
        present, place = sequence.find(asked)
        known = {x: i for i, x in enumerate(numbers.tolist())}
        assert [int(i) if p else None for i, p in zip(place, present)] == [
            known.get(x) for x in asked.tolist()]


def test_levels_search_only_their_context():
    rng = np.random.default_rng(4)
    for contexts, size, n in ((1, 1, 1), (4, 9, 20), (300, 500, 20000), (2000, 10**5, 3000)):
        rows = np.unique(rng.integers(0, contexts * size, n))
        values = rng.integers(0, 4096, len(rows))
        level = Level(as_bytes(Level.encode(
            contexts, rows // size, rows % size, values, 12)), 12)
        asked = np.concatenate([rows, rng.integers(0, contexts * size, 2000)])
        present, place = level.find(asked // size, asked % size)
        known = dict(zip(rows.tolist(), values.tolist()))
        got = level.value(place)
        assert [int(x) if p else None for x, p in zip(got, present)] == [
            known.get(x) for x in asked.tolist()]


class Plain:
    """The same model from its definition: counters, and logarithms that are not quantised."""

    def __init__(self, texts):
        self.n = [collections.Counter() for _ in range(3)]
        for words in texts:
            for u, v, w in self.runs(words):
                for order, run in enumerate(((w,), (v, w), (u, v, w))):
                    self.n[order][run] += 1
        self.total = [collections.Counter(), collections.Counter(), collections.Counter()]
        self.kinds = [collections.Counter(), collections.Counter(), collections.Counter()]
        for order in (1, 2):
            for run, count in self.n[order].items():
                self.total[order][run[:-1]] += count
                self.kinds[order][run[:-1]] += 1
        self.tokens, self.words = sum(self.n[0].values()), len(self.n[0])
        once, twice = (sum(c == k for c in self.n[0].values()) for k in (1, 2))
        self.first = (once + 0.5) / (once + 2 * twice + 1)

    @staticmethod
    def runs(words):
        # The end is None.
        padded = [None, None, *words, None]
        return zip(padded, padded[1:], padded[2:])

    def p(self, u, v, w):
        count = self.n[0][(w,)]
        share = (count - self.first if count else self.first * self.words + 1) / (self.tokens + 1)
        for order, context in ((1, (v,)), (2, (u, v))):
            total = self.total[order][context]
            if total:
                count = self.n[order][(*context, w)]
                share = (max(count - lm.DISCOUNT, 0) / total
                         + lm.DISCOUNT * self.kinds[order][context] / total * share)
        return share

    def score(self, words):
        return sum(math.log10(self.p(*run)) for run in self.runs(words))

    def row(self, words):
        counts = [self.n[0][(w,)] for w in (*words, None)]
        base = sum(math.log10((c + 1) / (self.tokens + self.words + 1)) for c in counts)
        return len(counts), sum(c > 0 for c in counts), self.tokens, round(base, 6)


def words_of(text):
    return WORD.findall((text or "").translate(ASCII_LOWER))


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def made_rows():
    """Texts with a word that is a third of all, copies, long runs, blanks, nulls and repeated rows."""
    rng = np.random.default_rng(8)
    rows = [(None, "no id, no ID"), (1, None), (2, ""), (3, " \n\t "), (4, "A a\x0bA é É"), (5, "x " * 3000)]
    for i in range(10, 90):
        words = [f"w{int(x)}" for x in rng.zipf(1.4, int(rng.integers(1, 60))) % 500]
        rows.append((i, " ".join(x for w in words for x in (["the", w] if rng.random() < 0.5 else [w]))))
    return rows + rows[:20] + [(i + 100, t) for i, t in rows[20:40]]


@pytest.mark.parametrize("sizes", [
    {}, {"resident": 20, "shard": 40, "wide": 40}, {"resident": 4, "shard": 10**6}, {"resident": 300, "shard": 300, "wide": 150}])
def test_scores_against_plain_counts(spark, sizes):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    model = Plain([words_of(t) for i, t in rows if not held_out(i)])
    got = collections.defaultdict(list)
    for r in lm.score_documents(docs, F.expr(TRAINING), **sizes).collect():
        got[r.doc_id].append(((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)),
                              r.score, r.held_out))
    assert sum(map(len, got.values())) == len(rows)
    for i, text in rows:
        words = words_of(text)
        for row, score, out in got[i]:
            assert out == held_out(i)
            assert row == model.row(words)
            # Half a step of each of at most three shares.
            step = -lm.LEAST / ((1 << lm.BITS) - 1)
            assert abs(score - model.score(words)) <= 1.6 * step * (len(words) + 1)


def test_plain_model_adds_up_to_one():
    texts = [words_of(t) for _, t in made_rows()]
    model = Plain(texts)
    every = [w for (w,) in model.n[0]] + ["never seen"]
    for context in ((None, None), (None, "the"), ("the", "w1"), ("w1", "the"), ("a", "never")):
        assert abs(sum(model.p(*context, w) for w in every) - 1) < 1e-9


def test_frequent_words_are_spread(spark, monkeypatch):
    """The runs of one very frequent word reach several shards."""
    docs = spark.createDataFrame(made_rows(), "doc_id long, text string")
    seen = []
    send = lm.send_pairs
    monkeypatch.setattr(lm, "send_pairs", lambda spread: seen.append(spread.value) or send(spread))
    lm.score_documents(docs, F.lit(True), shard=40, wide=40).collect()
    assert len(seen[0].words) and seen[0].ways.max() > 1
    assert len(seen[0].words) == len(seen[0].ways) and seen[0].ways.max() <= seen[0].shards


def test_long_texts_in_chunks_and_small_limits(spark, monkeypatch):
    rows = [(10 + i, t) for i, (_, t) in enumerate(made_rows())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = {r.doc_id: r for r in lm.score_documents(docs, F.expr(TRAINING)).collect()}
    # In one process: the functions of tasks, with limits that split texts, sums and look-ups.
    for name, value in (("CHUNK_TOKENS", 64), ("CHUNK_BITS", 6), ("DOCUMENTS", 3), ("LOOKED_UP", 50), ("HELD", 30),
                        ("KEPT", 100)):
        monkeypatch.setattr(lm, name, value)
    stream = small_run(rows)
    for doc_id, score in stream.items():
        assert abs(score - want[doc_id].score) < 1e-6 * max(1, abs(score))


def small_run(rows):
    """Scores by the tasks' own functions, fed by hand; every word is a resident."""
    import pyarrow as pa

    class Held:
        def __init__(self, value):
            self.value = value

    class Task:
        @staticmethod
        def get():
            return Task()

        def partitionId(self):
            return 0

    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array([i for i, _ in rows]), "text": pa.array([t for _, t in rows], pa.string()),
        "learned": pa.array([not held_out(i) for i, _ in rows])})
    learned = [t for i, t in rows if not held_out(i)]
    sums = collections.Counter()
    for _, tokens, _ in lm.token_stream(pa.array(learned, pa.string())):
        sums.update(tokens.tolist())
    n, v = sum(sums.values()), len(sums)
    once, twice = (sum(c == k for c in sums.values()) for k in (1, 2))
    first = (once + 0.5) / (once + 2 * twice + 1)
    known = Held(lm.Residents(np.array(list(sums), dtype=np.uint64).view(np.int64), list(sums.values())))
    spread = Held(lm.Spread(3, [], []))
    context, lm.TaskContext = lm.TaskContext, Task
    try:
        sent = list(lm.send_runs(known, spread, lambda c: np.log10((c + 1) / (n + v + 1)))([batch]))
    finally:
        lm.TaskContext = context
    table = pa.Table.from_batches(sent).sort_by([("shard", "ascending"), ("kind", "ascending")])
    parts = pa.Table.from_batches(list(lm.score_shards(
        known, spread, lambda c: (c - first) / (n + 1))(table.to_batches(max_chunksize=7)))).to_pylist()
    doc_of = {p["uid"]: p["doc_id"] for p in parts if p["tokens"] is not None}
    scores = collections.Counter()
    for p in parts:
        if p["score"] is not None:
            scores[doc_of[p["uid"]]] += p["score"]
        if p["n"] is not None:
            unknown = (first * v + 1) / (n + 1)
            scores[doc_of[p["uid"]]] += p["n"] * math.log10(p["a"] + p["b"] * unknown)
    return scores
