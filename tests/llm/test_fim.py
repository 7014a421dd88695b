"""Fill-in-middle: against SQL, plain string slicing, and exact round trips."""

import hashlib

import pytest
from __spark_entry__ import oracle_sql, queries
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spokeframe.llm import fim

ROWS = [
    (1, "plain ascii text of some length"), (2, "é🙂ü ñ漢字 mixed"), (3, None), (4, ""), (5, "x"),
    (6, "holds <S> itself"), (7, "< P > <P"), (7, "< P > <P"), (None, "no id"), (8, "<" * 50),
    (9, "S>" * 30), (-10, "long " * 60_000), (11, "\x00\n\t <M"),
]


def by_slices(doc_id, text, transformed=90, suffix_first=20):
    """The contract, on Python strings."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= transformed:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < suffix_first:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("parameters", [{}, {"transformed": 100, "suffix_first": 50}])
def test_outputs_and_round_trip(spark, parameters):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("n", "form", "output", "restored", "id_text")})
    got = fim.restore(fim.transform(docs, **parameters)).collect()
    want = [(i, *by_slices(i, t, **parameters), t or "") for i, t in ROWS]

    def key(row):
        return str(row)

    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored)
                   for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(r.restored.encode()).hexdigest()
    assert fim.restore(fim.transform(docs.where("false"))).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<PSM>é🙂a", max_size=30), st.integers(0, 500))
def test_every_text_comes_back(text, doc_id):
    data, said = next(fim._texts(fim.pa.array([text])))
    *told, table = fim.plan(data, said, str(doc_id), transformed=100, suffix_first=50)
    output = table.content()
    assert (*told, output.decode()) == by_slices(doc_id, text, 100, 50)
    assert fim.invert(output, told[1]).content().decode() == text


def test_code_points_are_counted_in_chunks(monkeypatch):
    monkeypatch.setattr(fim, "CHUNK", 7)
    text = "aé🙂b漢" * 9
    data, _ = next(fim._texts(fim.pa.array([text])))
    assert fim.code_points(data) == len(text)
    for k in range(len(text) + 1):
        assert fim.byte_offset(data, k) == len(text[:k].encode())


def test_splitting_moves_no_text():
    table = fim.PieceTable(b"abcdef").split(4).split(1).split(4)
    assert table.pieces == [(0, 0, 1), (0, 1, 4), (0, 4, 4), (0, 4, 6)]
    assert table.arranged([3, 1, 0]).content() == b"efbcda"


def test_query_matches_sql(spark, sf_dir):
    name = "op11_fill_in_middle"
    assert differences(queries()[name](spark, sf_dir), connect(sf_dir), oracle_sql()[name]) == []
