"""Periodic runs: against all stretches of all periods, compared word by word."""

import hashlib
import zlib

import numpy as np
import pytest
from __spark_entry__ import queries
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spokeframe.llm import runs


def brute(words):
    """Every maximal stretch of every period, a period's places compared at once."""
    found, seen = [], set()
    ids = np.unique(np.array(words, dtype=object), return_inverse=True)[1] if len(words) else \
        np.zeros(0, dtype=np.int64)
    for q in range(1, len(ids) // 4 + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        change = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2)
        for start, stop in change[change[:, 1] - change[:, 0] >= max(6 - q, 3 * q)].tolist():
            # A stretch of a smaller period is one of its multiples as well.
            if (start, stop + q) not in seen:
                seen.add((start, stop + q))
                found.append((start, stop + q - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def of_texts(texts):
    begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    ids = np.array([x for t in texts for x in t], dtype=np.int64)
    rows = runs.runs_of(ids, begins).tolist()
    return [[tuple(r[1:]) for r in rows if r[0] == i] for i in range(len(texts))]


def test_all_runs_against_brute_force():
    rng = np.random.default_rng(0)
    seen = set()
    for _ in range(120):
        texts = []
        for _ in range(rng.integers(1, 5)):
            words = []
            for _ in range(rng.integers(0, 5)):
                unit = rng.integers(0, int(rng.choice([2, 3, 50])),
                                    int(rng.integers(1, 70))).tolist()
                if rng.random() < 0.4:
                    unit = unit[:len(unit) // 2] * int(rng.integers(1, 12)) + unit[len(unit) // 2:]
                words += (unit * 9)[:max(1, int(len(unit) * rng.random() * 8))]
            texts.append(words[:600])
        want = [brute(t) for t in texts]
        assert of_texts(texts) == want
        seen |= {q.bit_length() for found in want for _, _, q in found}
    assert seen >= {1, 2, 3, 4, 5, 6}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), max_size=90), max_size=3))
def test_runs_over_two_words(texts):
    assert of_texts(texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("scale", [8, 16])
def test_the_set_is_locally_consistent_and_dense(scale):
    rng = np.random.default_rng(scale)
    ids = np.concatenate([rng.integers(0, 3, 300), rng.integers(0, 3, 40), rng.integers(0, 3, 300)])
    ids[340:640] = ids[:300]
    names = runs.mix(ids.astype(np.uint64) + np.uint64(7))
    width = 1
    while width < scale:
        wider = np.full(len(names), runs._NONE)
        wider[:-width] = runs.mix(names[:-width] * runs._LEFT + names[width:] * runs._RIGHT)
        names, width = wider, 2 * width
    end = np.full(len(ids), len(ids))
    marked = set(runs.synchronising_set(names, end, scale, []).tolist())
    assert {p for p in marked if p <= 300 - 2 * scale} == {
        p - 340 for p in marked if 340 <= p <= 640 - 2 * scale}
    assert all(marked & set(range(p, p + scale)) for p in range(len(ids) - 3 * scale))


def test_awkward_rows(spark):
    rows = [(1, "a b " * 40), (2, None), (3, ""), (4, " \n\t"), (5, "x"), (None, "z " * 7), (6, "z " * 5),
            (1, "a b " * 40), (7, "é é é é " * 9), (8, "A a " * 30), (9, "w " * 300_000),
            (10, " ".join(f"u{k}" for k in range(50)) + " v" * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("runs", "n_words", "collapsed", "start")})
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
                  for r in runs.periodic_runs(docs).collect()), key=str)
    want = []
    for i, t in rows:
        words = (t or "").encode().split()
        words = [w.decode() for w in words]
        found = [(0, 300_000, 1)] if i == 9 else brute(words)
        want.append((i, len(words), found, collapsed(words, found)))
    assert got == sorted(want, key=str)
    assert runs.periodic_runs(docs.where("false")).collect() == []


def test_long_texts_go_alone_and_short_ones_together(spark, monkeypatch):
    texts = [["a", "b", "c"] * 5, list("xyxyxyxyxy") + ["q"], [], ["t"] * 9]
    monkeypatch.setattr(runs, "CHUNK", 12)
    batch = runs.pa.RecordBatch.from_pydict(
        {"doc_id": list(range(4)), "text": [" ".join(t) for t in texts]})
    out = [r for b in runs._find([batch]) for r in b.to_pylist()]
    assert [r["doc_id"] for r in out] == [0, 1, 2, 3]
    for r, words in zip(out, texts):
        found = [tuple(x.values()) for x in r["runs"]]
        assert found == brute(words) and r["collapsed"] == collapsed(words, found)


def test_query_against_the_contract(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries()["op13_periodic_runs"](spark, sf_dir).collect()
    assert len(got) == len(docs) and sum(r.n_runs for r in got) > 5
    for r in got:
        words = [w.decode() for w in (docs[r.doc_id] or "").encode().split()]
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute(words)
        assert r.n_runs == len(found)
        best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (best[1] * 1000 // best[2] if found else None)
        said = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        assert r.runs_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, found).encode()).hexdigest()
