"""Personal data: base spans and revealing terms against plain Python and SQL."""

import collections
import math
import re

import duckdb
import pytest
from __spark_entry__ import oracle_sql, queries
from compare import connect, differences
from pyspark.sql import functions as F

from spokeframe.llm import columns, pii
from spokeframe.llm.queries import op12_personal_data

PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
NOISY = [
    "a.b+c@d-e.co.uk, é🙂 x@y z@w.1_q@r.st a@b.c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255 9.9.9",
    "4111 1111 1111 1111 4111-1111-1111-1112 411111111111111 4111  1111", "+1 (017) 555-7713 +1 2 +12345",
    "+44 20 7946 0958 ext +4420794609581234567", "12345678901234567890 4222222222222 37828224631000 5",
    "1.1.1.1@2.2.2.2 +1.2.3.4.567890", "@@@ . + - 1", "a" * 3000 + "@", "1" * 3000 + ".", "x@y.z" * 40,
    "no data at all", "", None, "+1 234 567 8901\n+1 234 567 8901 " * 300,
]
NAME = "Zyxgrvault"


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_base(text):
    found = []
    for kind, (name, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == 2 and 14 <= len(digits) <= 19 and luhn(digits)
                    or kind == 3 and 10 <= len(digits) <= 15)
            if good:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_base_spans_against_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(NOISY)), "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("base", "spans", "term", "tie", "start", "documents")})
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.base] for r in pii.scan(docs).collect()}
    assert got == {i: brute_base(t or "") for i, t in enumerate(NOISY)}
    assert sum(map(len, got.values())) > 600
    assert pii.scan(docs.where("false")).collect() == []


@pytest.mark.parametrize("n", [1, columns.BLOCK, columns.BLOCK + 1, 5000])
def test_matches_are_numbered_across_blocks(spark, n):
    text = "".join(f"é{k % 7 * 'z'}1" for k in range(n))
    got = spark.createDataFrame([(text,)], "t string").select(
        columns.matches(F.col("t"), "[0-9]").alias("m")).first().m
    assert [(m.start, m.end) for m in got] == [m.span() for m in re.finditer("[0-9]", text)]


def corpus():
    """Documents in which one name stands only beside one address, under different texts."""
    filler = "lorem ipsum dolor sit amet consetetur"
    rows = [(i, f"{filler} Kappa{chr(97 + i % 7)}" + chr(97 + i) * 3) for i in range(20)]
    rows += [(100 + i, f"{chr(97 + i) * 4} write to {NAME} ipsum, v.x@mail.org please {filler}")
             for i in range(3)]
    # Copies of one text reveal nothing; neither does what stands beside an entity once.
    rows += [(200 + i, "copied Qwertzuiop 10.20.30.40 all the same") for i in range(3)]
    rows += [(300, "Seldomly here +1 234 567 8901"), (301, "Otherwise here +1 (234) 567-8901"),
             (302, "elsewhere stands Otherwise as well")]
    rows += [(400 + i, f"{'pad ' * 60}{NAME}s v.x@mail.org" + " pad" * 60 + f" k{i}") for i in range(2)]
    return rows + [(500, None), (501, ""), (None, f"null {NAME}, V.X@mail.org")]


def brute_terms(rows):
    """Spans of removed and generalised terms by the definition."""
    word = re.compile(r"[^ \t-\r]+")
    core = re.compile(r"[^\w\s]*([^\W\d_]{3,}(?:['’-][^\W\d_]+)*)[^\w\s]*")
    holds, beside, term_docs = (collections.defaultdict(set) for _ in range(3))
    placed = collections.defaultdict(set)
    for i, text in rows:
        text = text or ""
        for w in word.findall(text.lower()):
            if m := core.fullmatch(w):
                term_docs[m[1]].add((i, text))
        for kind, (_, pattern) in enumerate(PATTERNS):
            ends = [0] + [m.end() for m in re.finditer(pattern, text)]
            starts = [m.start() for m in re.finditer(pattern, text)] + [len(text)]
            for k, m in enumerate(re.finditer(pattern, text)):
                if (m.start(), kind, m.end()) not in brute_base(text):
                    continue
                value = (m[0].lower(), m[0], *[re.sub("[^0-9]", "", m[0])] * 2)[kind]
                holds[kind, value].add((i, text))
                for lo, hi, whole in ((max(ends[k], m.start() - 120), m.start(), ends[k]),
                                      (m.end(), min(m.end() + 120, starts[k + 1]), starts[k + 1])):
                    for w in word.finditer(text[lo:hi]):
                        cut = (hi == m.start() and lo > whole and w.start() == 0
                               or lo == m.end() and hi < whole and w.end() == hi - lo)
                        c = core.fullmatch(w[0])
                        if c and not cut:
                            at = lo + w.start() + c.start(1)
                            beside[c[1].lower(), (kind, value)].add((i, text))
                            placed[i, text].add((at, at + len(c[1]), c[1].lower(), (kind, value)))
    got = collections.defaultdict(dict)
    for (i, text), terms in placed.items():
        for start, end, term, entity in terms:
            together = beside[term, entity]
            if len(together) < 2 or len({t for _, t in together}) < 2:
                continue
            strength = 1 - math.log(len(term_docs[term]) / len(together)) / math.log(
                len(rows) / len(holds[entity]))
            if strength >= 0.8:
                kind = 4 if strength >= 0.95 else 5
                got[i][start, end] = min(kind, got[i].get((start, end), 9))
    return {i: sorted((s, k, e) for (s, e), k in spans.items()) for i, spans in got.items()}


def test_revealing_terms_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in pii.scan(docs).collect():
        own = [(s.start, s.kind, s.end) for s in r.spans if s.kind >= pii.BASE_KINDS]
        assert [(s.start, s.kind, s.end) for s in r.spans if s.kind < pii.BASE_KINDS] == brute_base(
            dict(rows)[r.doc_id] or "")
        if own:
            got[r.doc_id] = own
    want = brute_terms(rows)
    assert got == want
    named = dict(rows)[100].index(NAME)
    assert (named, 4, named + len(NAME)) in got[100] and 200 not in got
    # Of the words beside the phone only the one in both texts reveals it.
    assert got[300] == [(9, 4, 13)] and got[301] == [(10, 4, 14)]


def test_query_on_revealing_terms_matches_sql(spark, tmp_path):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    df = op12_personal_data(spark, str(tmp_path))
    assert "removed:" in str(df.collect())
    assert differences(df, con, oracle_sql()["op12_personal_data"]) == []


def test_sanitised_texts(spark):
    docs = spark.createDataFrame(corpus() + [(600, "1.1.1.1@2.2.2.2")], "doc_id long, text string")
    got = {r.doc_id: r.sanitised for r in pii.sanitise(docs.withColumn("spans", F.lit(1))).collect()}
    assert got[100] == "aaaa  to  ipsum, <email>  lorem ipsum dolor sit amet consetetur"
    assert got[200] == "copied Qwertzuiop <ip> all the same"
    assert got[300] == "Seldomly  <phone>" and got[500] == "" and got[600] == "<email>"
    assert got[0] == corpus()[0][1]


def test_query_matches_sql(spark, sf_dir):
    name = "op12_personal_data"
    assert differences(queries()[name](spark, sf_dir), connect(sf_dir), oracle_sql()[name]) == []


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries()["op12_personal_data"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|NestedLoop|Cartesian", plan)
